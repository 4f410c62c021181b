"""Column expressions and vectorised functions."""
