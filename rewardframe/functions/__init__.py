"""Column -> Column builders (JVM-side expressions, usable in batch and streaming)."""
