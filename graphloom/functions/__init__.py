"""Column expressions, all evaluated in the JVM unless a docstring says otherwise."""
