"""Relational operators over genotype panels.  Calls are long: i, j, d."""
