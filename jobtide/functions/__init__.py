"""Column-level building blocks. Everything here stays on built-in Spark expressions."""
