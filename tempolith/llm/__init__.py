"""Operators for preparing training data, built on Spark DataFrames.

Nothing outside this folder imports it; ``registry`` lists its queries.
"""
