"""Queries over the test tables, each with the SQL of an independent engine."""
