"""Operators of a training-data pipeline, each on Spark DataFrames.

Nothing else in the library imports this subpackage. Every module holds one operator with a
general interface (DataFrame in, DataFrame out, column names as arguments); ``queries`` has the
thin registered queries on the test tables.
"""
