"""Operators for training-data pipelines, and their registered queries.

Nothing else in the library imports this subpackage. Each module holds one operator
with its own interface and the thin query that derives the digest columns from it.
"""
