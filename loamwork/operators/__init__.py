"""The operators of loamwork."""
