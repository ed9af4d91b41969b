"""Column -> Column expressions; all JVM-side and inside whole-stage codegen."""
