"""Column expressions shared by operators; all of them run in the JVM."""
