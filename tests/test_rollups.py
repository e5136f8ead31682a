from __future__ import annotations

from collections import defaultdict
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.bands import Band, band_of, gapless
from tidemark.operators.intervals import join_bands
from tidemark.operators.mentions import explode_mentions
from tidemark.operators.rollups import join_mentions_polarity, reddit_cumulative, reddit_daily
from tidemark.schemas import MENTIONS
from tidemark.sources.dimensions import BANDS, Project, band_rows, project_rows

D = date(2025, 1, 1)
SCHEMA = "content_type string, id string, created_date date, projects_mentions array<struct<project:string,mentions:int>>, projects_mentions_polarity array<struct<project:string,summary:string,polarity:double>>"

EDGES = [-1.0, -0.6, -0.5995, -0.1995, 0.1995, 0.5995, 0.6, 1.0, 1.2, None]
CATEGORIES = ["Very Negative", "Very Negative", None, None, None, None, "Very Positive", "Very Positive", None, None]


def test_band_edges(spark):
    df = spark.createDataFrame([(p,) for p in EDGES], "polarity double")
    assert [r[0] for r in df.select(band_of(F.col("polarity"), BANDS)).collect()] == CATEGORIES
    joined = join_bands(df, "polarity", band_rows(spark))
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(zip(EDGES, CATEGORIES), key=repr)


def test_overlapping_bands(spark):
    bands = [Band("low", 1, 0.0, 0.5), Band("high", 2, 0.5, 1.0)]
    with pytest.raises(ValueError):
        band_of(F.lit(0.5), bands)
    df = spark.createDataFrame([(0.5,), (2.0,)], "polarity double")
    found = sorted(map(tuple, join_bands(df, "polarity", band_rows(spark, bands)).collect()), key=repr)
    assert found == [(0.5, "high"), (0.5, "low"), (2.0, None)]


def test_gapless_bands(spark):
    df = spark.createDataFrame([(p,) for p in EDGES], "polarity double")
    found = [r[0] for r in df.select(band_of(F.col("polarity"), gapless(BANDS))).collect()]
    assert found == [
        "Very Negative", "Very Negative", "Very Negative", "Negative", "Neutral", "Positive",
        "Very Positive", "Very Positive", "Very Positive", None,
    ]


def test_unnest(spark):
    df = spark.createDataFrame(
        [("s", "1", D, None, None), ("s", "2", D, [], None), ("s", "3", D, [("a", 1)], None), ("s", "4", D, [("a", 1), ("b", 2)], None)],
        SCHEMA,
    )
    found = explode_mentions(df).select("id", "project", "mentions")
    assert sorted(map(tuple, found.collect())) == [("3", "a", 1), ("4", "a", 1), ("4", "b", 2)]


def band(p):
    if p is None:
        return None
    return next((b.category for b in BANDS if b.lower <= p <= b.upper), None)


def brute_daily(data, with_type=False):
    """Every pair of mention and polarity, as a nested loop."""
    groups = defaultdict(list)
    for kind, i, day, mentions, _ in data:
        for project, n in mentions or []:
            for kind2, i2, day2, _, scores in data:
                for project2, _, p in scores or []:
                    if (i, day, project) == (i2, day2, project2) and i is not None and (not with_type or kind == kind2):
                        groups[day, project, band(p)].append((n, p))
    out = set()
    for key, pairs in groups.items():
        scores = [p for _, p in pairs if p is not None]
        mean = round(sum(scores) / len(scores), 9) if scores else None
        out.add((*key, sum(n for n, _ in pairs), mean))
    return out


_LISTS = st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 4)), max_size=3)
_SCORES = st.lists(
    st.tuples(st.sampled_from("ab"), st.just("s"), st.sampled_from([-0.9, -0.5995, 0.0, 0.3, 1.5, None])), max_size=3
)
_CONTENT = st.tuples(
    st.sampled_from(["submission", "comment"]),
    st.sampled_from(["1", "2", None]),
    st.sampled_from([D, D + timedelta(days=1)]),
    st.one_of(st.none(), _LISTS),
    st.one_of(st.none(), _SCORES),
)


@settings(max_examples=10, deadline=None)
@given(st.lists(_CONTENT, min_size=1, max_size=12))
def test_daily_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    for with_type in (False, True):
        rollup = reddit_daily(df, BANDS, include_content_type=with_type)
        got = {(*r[:4], r[4] if r[4] is None else round(r[4], 9)) for r in rollup.collect()}
        assert got == brute_daily(data, with_type)


def test_ids_shared_by_kinds_match_across(spark):
    data = [
        ("submission", "1", D, [("a", 2)], [("a", "", 0.5)]),
        ("comment", "1", D, [("a", 3)], [("a", "", -0.5)]),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert {(r["polarity_category"], r["mentions_count"]) for r in reddit_daily(df, BANDS).collect()} == {
        ("Positive", 5), ("Negative", 5)
    }
    strict = reddit_daily(df, BANDS, include_content_type=True)
    assert {(r["polarity_category"], r["mentions_count"]) for r in strict.collect()} == {("Positive", 2), ("Negative", 3)}


def test_hot_id_is_not_multiplied_out(spark):
    """A third of all rows with one id: the pairs are counted, not built."""
    n = 40_000
    df = spark.range(3 * n).select(
        F.lit("comment").alias("content_type"),
        F.when(F.col("id") < n, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit(D).alias("created_date"),
        F.array(F.struct(F.lit("a").alias("project"), F.lit(1).alias("mentions"))).alias("projects_mentions"),
        F.array(
            F.struct(F.lit("a").alias("project"), F.lit("").alias("summary"), F.lit(0.5).alias("polarity"))
        ).alias("projects_mentions_polarity"),
    )
    pairs = join_mentions_polarity(df, BANDS).where("id = 'hot'").first()
    assert pairs["pairs"] == n * n
    (row,) = reddit_daily(df, BANDS).collect()
    assert (row["mentions_count"], row["avg_polarity"]) == (n * n + 2 * n, 0.5)


DAILY = "created_date date, project string, polarity_category string, mentions_count bigint, avg_polarity double"


def test_cumulative(spark):
    ref = D + timedelta(days=10)
    data = [
        (ref, "A", "Positive", 1, 0.5),
        (ref - timedelta(days=1), "A", "Positive", 9, 0.3),
        (ref - timedelta(days=7), "A", "Positive", 5, 0.2),
        (ref + timedelta(days=1), "A", "Positive", 100, 0.2),
        (ref, "A", None, 50, 1.5),
        (ref, "Other", "Positive", 50, 0.5),
    ]
    df = spark.createDataFrame(data, DAILY)
    projects = project_rows(spark, [Project("A", ("a",)), Project("B", ("b",))])
    rollup = {(r["project"], r["polarity_category"]): r for r in reddit_cumulative(df, projects, BANDS, ref).collect()}
    assert len(rollup) == 10
    hit = rollup["A", "Positive"]
    assert [hit[f"mentions_count{s}"] for s in ("", "_last_7_days", "_last_30_days", "_since_first_record")] == [1, 10, 15, 115]
    assert hit["avg_polarity_last_7_days"] == pytest.approx(0.4)
    assert set(tuple(rollup["B", "Neutral"])[3:]) == {0}
    weighted = reddit_cumulative(df, projects, BANDS, ref, weighted_avg=True, bounded_all_time=True)
    hit = weighted.where("project = 'A' and polarity_category = 'Positive'").first()
    assert hit["avg_polarity_last_7_days"] == pytest.approx(0.32)
    assert hit["mentions_count_since_first_record"] == 15


def test_rollup_needs_no_join_to_pair(spark):
    df = spark.createDataFrame([], MENTIONS.schema)
    plan = reddit_daily(df, BANDS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
