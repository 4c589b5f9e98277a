"""Column functions: built-in Spark expressions only, no Python in the hot path."""
