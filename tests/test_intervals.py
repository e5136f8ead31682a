"""Dyadic range joins against comparing every value with every band."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.intervals import band_totals, join_bands

BANDS = "polarity_category long, polarity_lower_bound double, polarity_upper_bound double"


def plain(values, bands):
    key = lambda x: (math.isnan(x), 0.0 if math.isnan(x) else x)
    out = []
    for i, v in values:
        known = [(c, a, b) for c, a, b in bands if None not in (v, a, b)]
        hits = [c for c, a, b in known if key(a) <= key(v) <= key(b)]
        out += [(i, c) for c in hits or [None]]
    return sorted(out, key=repr)


def joined(spark, values, bands):
    df = spark.createDataFrame(values, "i long, v double").repartition(3)
    return sorted(map(tuple, join_bands(df, "v", spark.createDataFrame(bands, BANDS)).select("i", "polarity_category").collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_comparisons(spark, seed):
    draw = random.Random(seed)
    special = [float("inf"), float("-inf"), float("nan"), -0.0, 0.0, None, 1.5]
    number = lambda: draw.choice(special) if draw.random() < 0.2 else round(draw.uniform(-3, 3), 1)
    bands = [(i, number(), number()) for i in range(draw.randint(1, 80))]
    values = [(i, number()) for i in range(150)]
    want = plain(values, bands)
    assert joined(spark, values, bands) == want and len(want) > 150


@pytest.mark.parametrize("seed", range(3))
def test_totals_equal_sums_of_pairs(spark, seed):
    draw = random.Random(seed)
    special = [float("inf"), float("-inf"), float("nan"), -0.0, 0.0, None, 1.5]
    number = lambda: draw.choice(special) if draw.random() < 0.2 else round(draw.uniform(-3, 3), 1)
    key = lambda: draw.choice([None, 2**62, -(2**62), draw.randint(-9, 9)])
    bands = [(key(), number(), number()) for _ in range(draw.randint(1, 80))]
    values = [(i, number()) for i in range(150)]
    keys = {i: [] for i, _ in values}
    for i, c in plain(values, bands):
        keys[i] += [] if c is None else [c]
    want = [(i, len(k), sum(k) if k else None) for i, k in keys.items() if abs(sum(k)) < 2**63]
    df = spark.createDataFrame([v for v in values if abs(sum(keys[v[0]])) < 2**63], "i long, v double").repartition(3)
    out = band_totals(df, "v", spark.createDataFrame(bands, BANDS)).select("i", "band_count", "band_sum")
    assert sorted(map(tuple, out.collect())) == want and len(want) > 20


def test_totals_of_bands_that_all_hold_all(spark):
    """10 to the 10 pairs, of which none is built."""
    n = 100_000
    bands = spark.range(n).select(
        F.col("id").alias("polarity_category"),
        (-F.col("id")).cast("double").alias("polarity_lower_bound"),
        F.lit(float(n)).alias("polarity_upper_bound"),
    )
    out = band_totals(spark.range(n).select(F.col("id").cast("double").alias("v")), "v", bands)
    assert out.agg(F.min("band_count"), F.max("band_count"), F.max("band_sum"), F.count("*")).first() == (n, n, n * (n - 1) // 2, n)


def test_totals_without_bands_or_values(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "i long, v double")
    none = spark.createDataFrame([], BANDS)
    assert sorted(map(tuple, band_totals(df, "v", none).collect())) == [(1, 2.0, 0, None), (2, None, 0, None)]
    assert band_totals(df.limit(0), "v", spark.createDataFrame([(1, 0.0, 9.0)], BANDS)).collect() == []


def test_points_copies_and_empty_tables(spark):
    values = [(1, 2.0), (1, 2.0), (2, None), (3, 5.0)]
    bands = [(7, 2.0, 2.0), (7, 2.0, 2.0), (8, 3.0, 1.0)]
    assert joined(spark, values, bands) == plain(values, bands)
    assert joined(spark, values, []) == plain(values, [])
    assert joined(spark, [], bands) == []


def test_many_overlapping_bands(spark):
    """200,000 bands that each hold some others; the join makes log n rows for a
    value, and the hits."""
    n = 200_000
    bands = spark.range(n).select(
        F.col("id").alias("polarity_category"), F.col("id").cast("double").alias("polarity_lower_bound"), (F.col("id") + F.col("id") % 5).cast("double").alias("polarity_upper_bound")
    )
    values = spark.range(0, n, 50).select((F.col("id") + 0.5).alias("v"))
    out = join_bands(values, "v", bands)
    # A band of width w holds the half numbers in it: those up to four before.
    assert out.where("polarity_category IS NOT NULL").count() == sum(
        1 for v in range(0, n, 50) for low in range(max(v - 4, 0), v + 1) if low + low % 5 > v
    )
