"""Column helpers (no Python UDFs: everything here stays in generated JVM code)."""
