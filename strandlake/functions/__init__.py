"""Column expressions and table helpers the operators are built from."""
