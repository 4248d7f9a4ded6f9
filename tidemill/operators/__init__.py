"""Functions from DataFrames to a DataFrame."""
