"""Column expressions: all built-in Spark functions, no Python per row."""
