"""Operators over transcript tables: DataFrame in, DataFrame out."""
