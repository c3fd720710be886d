"""Data products, each a function from DataFrames to a DataFrame."""
