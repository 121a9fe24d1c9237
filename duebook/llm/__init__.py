"""Operators of a training-data pipeline over text, vectors and web addresses.

Nothing else in the package imports this one. ``queries`` holds the checked queries.
"""
