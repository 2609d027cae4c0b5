"""Operators of a large-scale training-data pipeline.

Every operator is a function from DataFrames to a DataFrame with its own
general interface; :mod:`readkin.llm.queries` holds the thin registered
queries that derive the digest columns from them.  Nothing else in the
library imports this subpackage.
"""
