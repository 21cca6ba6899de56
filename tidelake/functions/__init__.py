"""Column expressions shared by all layers. Nothing here leaves the JVM."""
