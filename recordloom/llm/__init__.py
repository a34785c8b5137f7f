"""Operators of a training-data pipeline: quality, decontamination, dedup, packing, search, filters.

Nothing else in the package imports this subpackage.
"""
