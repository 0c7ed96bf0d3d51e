"""Column-level functions (pure Spark expressions, whole-stage codegen friendly)."""
