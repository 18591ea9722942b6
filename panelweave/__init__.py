"""Genotype-panel analytics on Spark DataFrames."""
