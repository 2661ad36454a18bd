"""The linkage stages, each a function from DataFrames to DataFrames."""
