"""Column-level helpers; all are built-in Spark expressions (JVM side, codegen)."""
