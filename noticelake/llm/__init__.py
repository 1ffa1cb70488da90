"""Operators of a training-data pipeline: scoring, filtering, extraction, search, mixing, deduplication and packing.

Nothing else in the library imports this subpackage.
"""
