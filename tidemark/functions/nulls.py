"""Null conventions of the tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(columns) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def empty_to_null(array: Column) -> Column:
    return F.when(F.size(array) > 0, array)


def falsy_to_null(edited: Column) -> Column:
    """``edited`` is a flag or a timestamp kept as text; false and 0 mean never."""
    return F.when(~edited.isin("false", "0", "0.0"), edited)


def blank_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))
