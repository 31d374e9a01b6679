"""Column helpers: built-in Spark expressions only, no Python UDFs."""
