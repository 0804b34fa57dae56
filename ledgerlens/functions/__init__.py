"""Column expressions; everything here is built from JVM-side functions."""
