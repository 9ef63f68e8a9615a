"""Column expressions: no shuffle, no action, whole-stage codegen."""
