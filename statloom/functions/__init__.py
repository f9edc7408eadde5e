"""Column expressions; all of them stay on the JVM except the Arrow pair scorer."""
