"""Relational operators: DataFrame in, DataFrame out. No actions, no clock."""
