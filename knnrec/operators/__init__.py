"""Operators of the kNN pipeline; each takes and returns DataFrames."""
