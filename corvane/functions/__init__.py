"""Column expressions: geometry, text tokens and vectors."""
