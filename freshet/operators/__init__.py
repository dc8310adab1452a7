"""Operators: each takes and returns a DataFrame."""
