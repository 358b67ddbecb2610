"""Relational operators of the study (DataFrame in, DataFrame out)."""
