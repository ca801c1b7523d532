"""Column expressions and ordered-series helpers shared by the operators."""
