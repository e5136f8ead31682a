"""Running sums per key and day, kept as a table.

A row holds the sums of a key over all days up to its own, and every key has a
row on every day from its first one on. Any window that ends on a day is then
the difference of two rows of a key: those of its last day and of the day before
its first one. A rollup of all windows reads one day of prefix rows per window,
however long the history is.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.bands import Band
from tidemark.functions.dates import date_literal, ds_add
from tidemark.functions.nulls import zero_if_null
from tidemark.operators.rollups import spine
from tidemark.operators.windows import ALL_TIME, WINDOWS, shown, suffix
from tidemark.schemas import CUMULATIVE_KEYS

DAY = "prefix_date"


def prefix_rows(
    rows: DataFrame,
    day: str,
    keys: Sequence[str],
    sums: Sequence[str],
    first: date | str,
    last: date | str,
    before: DataFrame | None = None,
) -> DataFrame:
    """The prefix rows (prefix_date, keys, sums) of the days ``first`` to
    ``last``, from the rows of these days and the prefix rows of the day before
    the first; without these, from all history.

    Rows without a date count from the beginning, rows after ``last`` do not.
    One shuffle on the keys: a key has at most one row a day in it, whatever its
    share of the input.
    """
    start, end = date_literal(first), date_literal(last)
    dated = rows.where(F.col(day).isNull() | (F.col(day) <= end)).select(
        F.greatest(F.coalesce(F.col(day), start), start).alias(DAY), *keys, *sums
    )
    if before is not None:
        dated = dated.unionByName(before.select(start.alias(DAY), *keys, *sums))
    daily = dated.groupBy(DAY, *keys).agg(*[F.sum(c).alias(c) for c in sums])
    in_order = Window.partitionBy(*keys).orderBy(DAY)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.date_sub(F.lead(DAY).over(in_order), 1), end)
    running = daily.select(
        DAY, *keys, *[F.sum(c).over(so_far).cast(daily.schema[c].dataType).alias(c) for c in sums], until.alias("_until")
    )
    return running.withColumn(DAY, F.explode(F.sequence(DAY, "_until"))).drop("_until")


def prefix_days(reference: date | str, windows: Sequence[int] = WINDOWS) -> list[date]:
    """The days whose prefix rows make up the rollup of a date."""
    return [ds_add(reference, 0), *(ds_add(reference, -d) for d in windows)]


def window_differences(
    prefix: DataFrame, keys: Sequence[str], sums: Sequence[str], reference: date | str, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Sums of all windows for every key, named by value and window. Reads the
    prefix rows of :func:`prefix_days` only."""
    days = [date_literal(d) for d in prefix_days(reference, windows)]
    now = F.col(DAY) == date_literal(reference)

    def over(days_back: int | None, value: str) -> Column:
        ahead = F.when(now, F.col(value))
        if days_back is not ALL_TIME:
            left = F.col(DAY) == date_literal(ds_add(reference, -days_back))
            ahead = F.when(now, F.col(value)).when(left, -F.col(value))
        return F.sum(ahead).alias(f"{value}{suffix(days_back)}")

    columns = [over(d, value) for d in (*windows, ALL_TIME) for value in sums]
    return prefix.where(F.col(DAY).isin(days)).groupBy(*keys).agg(*columns)


def downloads_from_prefix(
    prefix: DataFrame, reference: date | str, windows: Sequence[int] = WINDOWS, *, null_safe_keys: bool = False
) -> DataFrame:
    """The rollup of :func:`windows.pypi_cumulative` for a date, without later
    days, from prefix rows with a running ``download_count``."""
    totals = window_differences(prefix, CUMULATIVE_KEYS, ["download_count"], reference, windows)
    return shown(totals, reference, windows, null_safe_keys)


MENTION_KEYS = ("project", "polarity_category")
MENTION_SUMS = ("mentions_count", "polarity_sum", "polarity_days", "weighted_sum", "weight")


def mention_sums(daily: DataFrame) -> DataFrame:
    """Daily mentions with what their running sums and means are made of.
    Means are summed as decimals, so differences of running sums are exact."""
    mean = F.col("avg_polarity").cast("decimal(20,18)")
    known = F.col("avg_polarity").isNotNull()
    return daily.where(F.col("project").isNotNull() & F.col("polarity_category").isNotNull()).select(
        "created_date",
        *MENTION_KEYS,
        F.col("mentions_count").cast("long").alias("mentions_count"),
        F.coalesce(mean, F.lit(0)).cast("decimal(38,18)").alias("polarity_sum"),
        known.cast("long").alias("polarity_days"),
        F.coalesce(mean * F.col("mentions_count").cast("decimal(10)"), F.lit(0)).cast("decimal(38,18)").alias("weighted_sum"),
        F.when(known, F.col("mentions_count")).otherwise(0).cast("long").alias("weight"),
    )


def mentions_from_prefix(
    prefix: DataFrame,
    projects: DataFrame,
    bands: Sequence[Band],
    reference: date | str,
    windows: Sequence[int] = WINDOWS,
    *,
    weighted_avg: bool = False,
) -> DataFrame:
    """The rollup of :func:`rollups.reddit_cumulative` for a date, without later
    days, from prefix rows of :func:`mention_sums`."""
    totals = window_differences(prefix, MENTION_KEYS, MENTION_SUMS, reference, windows)
    total, count = ("weighted_sum", "weight") if weighted_avg else ("polarity_sum", "polarity_days")
    values = []
    for end in map(suffix, (*windows, ALL_TIME)):
        mean = F.col(f"{total}{end}").cast("double") / F.nullif(F.col(f"{count}{end}"), F.lit(0))
        values += [zero_if_null(F.col(f"mentions_count{end}")).alias(f"mentions_count{end}"), zero_if_null(mean).alias(f"avg_polarity{end}")]
    joined = spine(projects, bands).join(totals, list(MENTION_KEYS), "left")
    return joined.select(date_literal(reference).alias("reference_date"), *MENTION_KEYS, *values)
