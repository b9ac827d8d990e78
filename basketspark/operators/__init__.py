"""Operators of the job; each is a function from DataFrames to DataFrames."""
