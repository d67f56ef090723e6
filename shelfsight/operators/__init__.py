"""Operators: DataFrames in, DataFrame out, nothing evaluated unless the docstring says so."""
