"""The functions of loamwork."""
