"""Urban sensor analytics expressed as Spark DataFrame operations."""
