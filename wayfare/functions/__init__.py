"""Column functions: pure expressions, no Python UDFs."""
