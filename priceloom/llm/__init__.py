"""Operators of a training-data pipeline: near copies, filters, mixing, packing, formatting, search.

Nothing else in the library imports this subpackage.
"""
