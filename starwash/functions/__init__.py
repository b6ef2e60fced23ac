"""Column-to-column functions. All of them are built-in Spark expressions."""
