"""Column helpers. Every helper is a native Spark expression."""
