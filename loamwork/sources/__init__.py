"""The sources of loamwork."""
