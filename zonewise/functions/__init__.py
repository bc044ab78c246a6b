"""Column expressions: everything here is row-local and stays inside JVM code generation."""
