"""Column functions: text, physics and flag bits."""
