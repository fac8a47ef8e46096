"""Relational, text and ML operators: DataFrame(s) -> DataFrame."""
