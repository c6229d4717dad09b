"""Operators of the catalogue: DataFrame in, DataFrame out."""
