"""Readers: everything that turns landed bytes or official lists into DataFrames."""
