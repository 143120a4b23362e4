"""Operators of a training-data pipeline over large text, vector and page tables.

Nothing else in the library imports this subpackage.
"""
