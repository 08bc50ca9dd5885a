"""The streaming of loamwork."""
