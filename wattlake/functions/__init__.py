"""Column functions: all of them build Spark expressions, none runs Python per row."""
