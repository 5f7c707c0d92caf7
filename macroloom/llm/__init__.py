"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this subpackage. Every operator takes DataFrames and column
names; ``queries`` binds each to the driver's tables.
"""
