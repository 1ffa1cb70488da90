"""Queries over the supplied tables: every operator on inputs derived from them, with an oracle.

Domain inputs are pure SQL expressions of the supplied tables, written in the subset that
Spark and DuckDB share, so both sides start from the same rows.
"""
