"""Column-expression builders (run inside whole-stage codegen, no Python)."""
