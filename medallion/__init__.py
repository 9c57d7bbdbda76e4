"""Zoned data-lake ingestion and refinement on Spark DataFrames.

Nothing here creates a session or sets a master. Operators of the lake are
compositions of built-in DataFrame expressions.
"""
