"""Column-level building blocks (native Spark expressions, no UDFs)."""
