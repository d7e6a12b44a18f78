"""Relational operators on DataFrames; each takes and returns DataFrames and collects nothing."""
