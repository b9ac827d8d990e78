"""Operators of a training-data pipeline: quality, near-duplicates, scans, packing, tokens.

Nothing else in the library imports this subpackage. Each operator is a function from
DataFrames to DataFrames in a module of its own; ``queries`` applies them to the test tables
and ``oracle`` holds the SQL of those that SQL can express.
"""
