"""Column → Column building blocks; all JVM-side, no Python workers."""
