"""Left range join with a table of bands, by dyadic intervals.

The bounds of all bands, in order, cut the number line into places: each bound
is one, and so is each gap between two. A band covers a run of places, which is
cut into at most two dyadic intervals a level, O(log n) in all. A value stands
in one place and in one dyadic interval a level. A band holds a value exactly if
one of its intervals is one of the value's, and only one can be. So the range
join is an equi-join whose work is the values times log n, and the hits.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import storage

LOWER, UPPER, CATEGORY = "polarity_lower_bound", "polarity_upper_bound", "polarity_category"


def _written(df: DataFrame, label: str) -> DataFrame:
    spark, path = df.sparkSession, storage.scratch(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def places(values: DataFrame, bounds: DataFrame) -> tuple[DataFrame, int]:
    """(at, place) of every distinct ``at`` of two tables of numbers, and the
    number of bounds. Bound i in order has place 2i + 1, what lies below it and
    above the one before has 2i. NaN is above all numbers, as everywhere in
    Spark; NULLs have no place."""
    number = (F.col("at").cast("double") + 0.0).alias("at")
    both = bounds.select(number, F.lit(1).alias("bound")).unionByName(values.select(number, F.lit(0).alias("bound")))
    distinct = both.where(F.col("at").isNotNull()).groupBy("at").agg(F.max("bound").alias("bound"))
    counted = _running(distinct, ["bound"], "band-bounds")
    n = counted.agg(F.max("upto_bound")).first()[0] or 0
    return counted.select("at", (2 * F.col("upto_bound") - F.col("bound")).alias("place")), n


def _running(distinct: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Add to each row what ``columns`` sum up to, in the order of ``at``, as
    ``upto_`` and their name: sums inside ranges, and those of all ranges before."""
    # Ranges are drawn by sampling: the table is written, so that they are
    # drawn once.
    ordered = distinct.repartitionByRange("at").withColumn("part", F.spark_partition_id())
    ordered = _written(ordered, label)
    parts = ordered.groupBy("part").agg(*[F.sum(c).alias(c) for c in columns])
    # One row a partition, and sums over them.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in columns])
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ordered.withColumns({f"upto_{c}": F.sum(c).over(within) for c in columns}).join(offsets, "part")
    return summed.withColumns({f"upto_{c}": F.col(f"before_{c}") + F.col(f"upto_{c}") for c in columns})


def _ends(bands: DataFrame, *columns: Column) -> DataFrame:
    """(low, high) and ``columns`` of the bands that can hold a value."""
    return bands.where(F.col(LOWER) <= F.col(UPPER)).select(
        (F.col(LOWER).cast("double") + 0.0).alias("low"), (F.col(UPPER).cast("double") + 0.0).alias("high"), *columns
    )


def join_bands(df: DataFrame, value: str, bands: DataFrame) -> DataFrame:
    """Add the category of each band (polarity_category, polarity_lower_bound,
    polarity_upper_bound) that holds a value, both ends included: a row for each
    band, and one with NULL if there is none.

    Bands may overlap, repeat, be points or endless; one with a NULL end or its
    ends exchanged holds nothing. NULL values are in no band.
    """
    at = df.select(F.col(value).alias("at"))
    ends = _ends(bands, F.col(CATEGORY))
    located, n = places(at.distinct(), ends.select(F.explode(F.array("low", "high")).alias("at")))
    located = _written(located, "band-places")
    levels = F.explode(F.sequence(F.lit(0), F.lit(math.ceil(math.log2(2 * n + 2))))).alias("level")
    spans = (
        ends.join(located.toDF("low", "first"), "low")
        .join(located.toDF("high", "last"), "high")
        .select("first", F.col("last") + 1, CATEGORY, levels)
        .toDF("first", "end", CATEGORY, "level")
        # The first whole interval of the level, and the one after the last.
        .selectExpr(CATEGORY, "level", "-shiftright(-first, level) AS first", "shiftright(end, level) AS end")
        .where("first < end")
    )
    pieces = spans.select(
        "level",
        F.explode(F.filter(F.array(_if_odd("first", 0), _if_odd("end", 1)), lambda x: x.isNotNull())).alias("interval"),
        CATEGORY,
    )
    ancestors = located.select("at", "place", levels).selectExpr("at", "level", "shiftright(place, level) AS interval")
    hits = ancestors.join(pieces, ["level", "interval"]).select(F.col("at").alias("_band_at"), CATEGORY)
    return df.join(hits, F.col(value).cast("double") == F.col("_band_at"), "left").drop("_band_at")


def _if_odd(name: str, back: int) -> Column:
    return F.when(F.col(name) % 2 == 1, F.col(name) - back)


def band_totals(df: DataFrame, value: str, bands: DataFrame, number: str = CATEGORY) -> DataFrame:
    """Add how many bands hold a value (``band_count``) and the sum of their
    whole numbers ``number`` (``band_sum``, NULL if there are none): the same as
    ``join_bands`` and sums over its rows, which this does not make. Bands whose
    number is NULL do not count; a sum beyond 64 bits fails.

    What holds a value are the bands that have begun, without those that ended
    before it: a difference of running sums, however many there are.
    """
    key = F.col(number).cast("decimal(19,0)").alias("key")
    ends = _ends(bands.where(F.col(number).isNotNull()), key)
    nothing = [F.lit(0).cast(kind).alias(c) for c, kind in _BOUNDS.items()]
    at = (F.col(value).cast("double") + 0.0).alias("at")
    values = df.where(F.col(value).isNotNull()).select(at, *nothing)
    minus = F.lit(-1).cast("long")
    bounds = ends.select(
        F.inline(
            F.array(
                _bound("low", F.lit(1).cast("long"), F.col("key"), begins=True),
                _bound("high", minus, -F.col("key"), begins=False),
            )
        )
    )
    distinct = values.unionByName(bounds).groupBy("at").agg(*[F.sum(c).alias(c) for c in _BOUNDS])
    summed = _running(distinct, ["n", "key"], "band-totals")
    # A band that ends at a value holds it.
    totals = summed.select(
        F.col("at").alias("_band_at"),
        (F.col("upto_n") - F.col("ended_n")).alias("_count"),
        (F.col("upto_key") - F.col("ended_key")).alias("_sum"),
    ).where("_count > 0")
    joined = df.join(totals, F.col(value).cast("double") == F.col("_band_at"), "left")
    count = F.coalesce("_count", F.lit(0).cast("long"))
    return joined.withColumns({"band_count": count, "band_sum": F.col("_sum").cast("long")}).drop("_band_at", "_count", "_sum")


# What bands that begin or end at a number add to the sums from there on, and
# what those that end there took away.
_BOUNDS = {"n": "long", "key": "decimal(19,0)", "ended_n": "long", "ended_key": "decimal(19,0)"}


def _bound(at: str, n: Column, key: Column, *, begins: bool) -> Column:
    zero = F.lit(0)
    columns = {"n": n, "key": key, "ended_n": zero if begins else n, "ended_key": zero if begins else key}
    return F.struct(F.col(at).alias("at"), *[columns[c].cast(kind).alias(c) for c, kind in _BOUNDS.items()])
