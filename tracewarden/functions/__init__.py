"""Column expressions: every field rule is a built-in Spark expression."""
