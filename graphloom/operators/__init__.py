"""Graph and table operators, each a function from DataFrames to DataFrames."""
