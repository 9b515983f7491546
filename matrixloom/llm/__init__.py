"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it. Every operator takes DataFrames and returns DataFrames.
"""
