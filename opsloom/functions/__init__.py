"""Column builders: each takes and returns Spark columns, nothing is executed."""
