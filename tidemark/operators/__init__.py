"""Operators: DataFrame in, DataFrame out, no action inside unless said."""
