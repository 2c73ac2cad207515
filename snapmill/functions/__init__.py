"""Column to Column helpers. Every one is built from JVM-side expressions."""
