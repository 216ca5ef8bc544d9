"""Column functions. All of them stay JVM-side."""
