"""Mentions and polarity rolled up per day, and per trailing window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bands import Band, band_of, gapless
from tidemark.functions.dates import date_literal
from tidemark.functions.nulls import zero_if_null
from tidemark.operators.windows import ALL_TIME, WINDOWS, suffix, within


def join_mentions_polarity(
    content: DataFrame,
    bands: Sequence[Band],
    *,
    include_content_type: bool = False,
    gapless_bands: bool = False,
) -> DataFrame:
    """Mention counts matched with polarities on (day, id, project), per band.

    The content type is not part of the match by default, so a submission and
    a comment with one id match each other's mentions. Where both sides hold
    several rows of a key, every pair counts: ``mentions_count`` is the sum of
    mentions over the pairs, ``pairs`` their number and ``polarity_sum`` the
    sum of their polarities. The pairs are never built. Both lists of a row
    are exploded together and summed per key, and the sums are multiplied:
    one scan, one shuffle, and a hot id is combined before it.
    """
    keys = ["created_date", "id", "project"]
    if include_content_type:
        keys.insert(2, "content_type")
    used = gapless(bands) if gapless_bands else list(bands)
    none = F.lit(None)
    entries = F.concat(
        F.coalesce(
            F.transform("projects_mentions", lambda m: _entry(m["project"], m["mentions"], none)),
            F.array(),
        ),
        F.coalesce(
            F.transform(
                "projects_mentions_polarity", lambda p: _entry(p["project"], none, p["polarity"], F.lit(True))
            ),
            F.array(),
        ),
    )
    sides = (
        content.select(*[k for k in keys if k != "project"], F.inline(entries))
        .where(F.col("project").isNotNull() & F.col("id").isNotNull())
        .withColumn("band", F.when(F.col("scored"), band_of(F.col("polarity"), used)))
    )
    slots = [*[b.category for b in used], None]

    def in_slot(category: str | None) -> Column:
        match = F.col("band").isNull() if category is None else F.col("band") == category
        return F.col("scored") & match

    by_key = sides.groupBy(*keys).agg(
        F.sum("mentions").alias("mentions"),
        F.count("mentions").alias("mention_rows"),
        *[
            column
            for i, category in enumerate(slots)
            for column in (
                F.count_if(in_slot(category)).alias(f"n{i}"),
                F.sum(F.when(in_slot(category), F.col("polarity"))).alias(f"p{i}"),
                F.count(F.when(in_slot(category), F.col("polarity"))).alias(f"v{i}"),
            )
        ],
    )
    per_band = F.array(
        *[
            F.struct(
                F.lit(category).cast("string").alias("polarity_category"),
                (F.col("mentions") * F.col(f"n{i}")).alias("mentions_count"),
                (F.col("mention_rows") * F.col(f"n{i}")).alias("pairs"),
                (F.col("mention_rows") * F.col(f"v{i}")).alias("scored_pairs"),
                (F.col("mention_rows") * F.col(f"p{i}")).alias("polarity_sum"),
            )
            for i, category in enumerate(slots)
        ]
    )
    return by_key.select(*keys, F.inline(per_band)).where(F.col("pairs") > 0)


def _entry(project: Column, mentions: Column, polarity: Column, scored: Column | None = None) -> Column:
    return F.struct(
        project.alias("project"),
        mentions.cast("int").alias("mentions"),
        polarity.cast("double").alias("polarity"),
        (F.lit(False) if scored is None else scored).alias("scored"),
    )


def reddit_daily(content: DataFrame, bands: Sequence[Band], **options: bool) -> DataFrame:
    """Mentions and mean polarity per day, project and band; polarities in no
    band form a NULL band. Pass one day's rows, or any number of days."""
    matched = join_mentions_polarity(content, bands, **options)
    return matched.groupBy("created_date", "project", "polarity_category").agg(
        F.sum("mentions_count").alias("mentions_count"),
        (F.sum("polarity_sum") / F.nullif(F.sum("scored_pairs"), F.lit(0))).alias("avg_polarity"),
    )


def spine(projects: DataFrame, bands: Sequence[Band]) -> DataFrame:
    """Every project with every band. The bands are a literal list, so this is
    an explode of each project row and not a join."""
    categories = F.array(*[F.lit(b.category) for b in bands])
    return projects.select(
        F.col("project_name").alias("project"), F.explode(categories).alias("polarity_category")
    )


def reddit_cumulative(
    daily: DataFrame,
    projects: DataFrame,
    bands: Sequence[Band],
    reference: date | str,
    windows: Sequence[int] = WINDOWS,
    *,
    weighted_avg: bool = False,
    bounded_all_time: bool = False,
) -> DataFrame:
    """All windows for every project and band, 0 where there is nothing.

    One pass over the daily table and one join with the spine. The mean is of
    the daily means unless ``weighted_avg`` weighs them by mentions. Daily rows
    without a band, or of other projects, do not appear.
    """
    day, n, mean = "created_date", F.col("mentions_count"), F.col("avg_polarity")
    if bounded_all_time:
        daily = daily.where(F.col(day) <= date_literal(reference))

    def average(days: int | None) -> Column:
        if not weighted_avg:
            return F.avg(within(day, reference, days, mean))
        weight = F.when(mean.isNotNull(), n)
        total = F.sum(within(day, reference, days, weight))
        return F.sum(within(day, reference, days, mean * n)) / F.nullif(total, F.lit(0))

    spans = (*windows, ALL_TIME)
    keys = ["project", "polarity_category"]
    totals = (
        daily.where(F.col("project").isNotNull() & F.col("polarity_category").isNotNull())
        .groupBy(*keys)
        .agg(
            *[
                column
                for d in spans
                for column in (
                    F.sum(within(day, reference, d, n)).alias(f"mentions_count{suffix(d)}"),
                    average(d).alias(f"avg_polarity{suffix(d)}"),
                )
            ]
        )
    )
    values = [c for c in totals.columns if c not in keys]
    return (
        spine(projects, bands)
        .join(totals, keys, "left")
        .select(
            date_literal(reference).alias("reference_date"),
            *keys,
            *[zero_if_null(F.col(c)).alias(c) for c in values],
        )
    )
