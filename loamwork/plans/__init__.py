"""The plans of loamwork."""
