"""Column -> Column building blocks (JVM-side expressions unless noted)."""
