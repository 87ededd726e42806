"""Operators for building training data, each a Spark job over whole tables.

Nothing else in the library imports this package. Its queries are in :mod:`martlet.llm.queries`.
"""
