"""Column expressions used by several operators; all run inside the JVM."""
