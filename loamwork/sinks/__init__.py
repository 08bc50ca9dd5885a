"""Where tables go."""
