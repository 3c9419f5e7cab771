"""Column expressions used by the operators. All of them stay inside the JVM."""
