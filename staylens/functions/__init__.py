"""Column-level functions (all JVM-side built-in expressions)."""
