"""Running streams."""
