"""Column expressions; every function returns a ``Column`` and runs JVM-side."""
