"""Column functions: pure expressions, no data movement."""
