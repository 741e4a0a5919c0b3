"""Column -> Column helpers; all JVM-side."""
