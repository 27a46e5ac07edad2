"""Column-expression functions."""
