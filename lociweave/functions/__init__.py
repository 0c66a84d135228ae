"""Column expressions; all run inside the JVM, none is a Python UDF."""
