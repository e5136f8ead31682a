"""Typed columns out of all-string rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_list(text: Column) -> Column:
    """``'[a, b]'`` to an array; ``'[]'`` gives one empty string."""
    return F.split(F.substring(text, F.lit(2), F.length(text) - 2), ", ")


def decoded(column: Column, dtype: T.DataType) -> Column:
    """One string column as ``dtype``; a missing value stays NULL."""
    if isinstance(dtype, T.DateType):
        return F.to_date(column, "yyyy-MM-dd")
    if isinstance(dtype, (T.IntegerType, T.FloatType, T.DoubleType)):
        return column.cast(dtype)
    if isinstance(dtype, T.StringType):
        return column
    if dtype == T.ArrayType(T.StringType()):
        return split_list(column)
    raise ValueError(f"no decoding from text to {dtype.simpleString()}")


def typed_from_strings(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All-string rows to a declared schema; text that does not parse fails the
    job (ANSI), a type without a rule fails before it starts."""
    return df.select(*[decoded(F.col(f.name), f.dataType).alias(f.name) for f in schema])
