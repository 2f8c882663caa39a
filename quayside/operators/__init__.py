"""Relational operators: each takes DataFrames and parameters and returns a DataFrame, without acting on it."""
