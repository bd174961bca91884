"""Operators of a training-data pipeline: scoring, mixing, output, filters and deduplication.

Nothing else in the library imports this subpackage.
"""
