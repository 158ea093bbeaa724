"""Column functions: every rule is a Column expression, so it stays in codegen."""
