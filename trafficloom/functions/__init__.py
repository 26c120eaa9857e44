"""Column functions: every one takes and returns Columns and runs inside the JVM."""
