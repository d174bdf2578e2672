"""Column expressions and small DataFrame helpers shared by the operators."""
