"""Where tables and messages come from."""
