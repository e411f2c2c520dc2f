"""One module per group of operators; every function maps DataFrames to DataFrames."""
