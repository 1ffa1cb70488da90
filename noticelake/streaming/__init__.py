"""Structured Streaming forms of the landing, change, run and plate operators."""
