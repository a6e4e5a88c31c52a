"""Column expressions; all stay inside generated JVM code."""
