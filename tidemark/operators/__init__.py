"""Operators: DataFrame in, DataFrame out; and the table sinks."""
