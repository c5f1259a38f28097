"""Column expressions: built-in functions only, nothing leaves the JVM."""
