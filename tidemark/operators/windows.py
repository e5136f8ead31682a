"""Trailing windows that end on a reference date.

The windows are nested (today, 7, 30, 90, 365 days, all time), so all of them
come out of one scan and one aggregation: each row adds to the windows its
date falls in. Sums are combined before the shuffle, so what moves is one row
per key and task however many rows a key has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_literal, ds_add, in_trailing_window
from tidemark.functions.nulls import any_null, zero_if_null
from tidemark.schemas import CUMULATIVE_KEYS

WINDOWS = (1, 7, 30, 90, 365)
ALL_TIME = None


def suffix(days: int | None) -> str:
    if days is ALL_TIME:
        return "_since_first_record"
    return "" if days == 1 else f"_last_{days}_days"


def window_rows(df: DataFrame, day: str, reference: date | str, days: int | None) -> DataFrame:
    """The rows of one window; all-time has no bound at all."""
    return df if days is ALL_TIME else df.where(in_trailing_window(F.col(day), reference, days))


def window_sum(downloads: DataFrame, reference: date | str, days: int | None) -> DataFrame:
    """Downloads per project, version and country in one window. Reads only
    the window's date partitions."""
    rows = window_rows(downloads, "download_date", reference, days)
    return rows.groupBy(*CUMULATIVE_KEYS).agg(F.sum("download_count").alias("download_count"))


def window_sum_avg(daily: DataFrame, reference: date | str, days: int | None) -> DataFrame:
    """Mentions and mean of the daily means per project and band in one window."""
    rows = window_rows(daily, "created_date", reference, days)
    return rows.groupBy("project", "polarity_category").agg(
        F.sum("mentions_count").alias("mentions_count"),
        F.avg("avg_polarity").alias("avg_polarity"),
    )


def within(day: str, reference: date | str, days: int | None, value: Column) -> Column:
    """A value where its date is in the window, NULL elsewhere."""
    if days is ALL_TIME:
        return value
    return F.when(in_trailing_window(F.col(day), reference, days), value)


def pypi_cumulative(
    downloads: DataFrame,
    reference: date | str,
    windows: Sequence[int] = WINDOWS,
    *,
    null_safe_keys: bool = False,
    bounded_all_time: bool = False,
) -> DataFrame:
    """All trailing sums per project, version and country for one date.

    Every key ever seen gets a row. By default a key with a NULL part shows 0
    in every window but its real all-time total (the windows are matched by
    plain equality), and all-time also counts later dates.
    """
    day, n = "download_date", F.col("download_count")
    if bounded_all_time:
        downloads = downloads.where(F.col(day) <= date_literal(reference))
    sums = [
        F.sum(within(day, reference, d, n)).alias(f"download_count{suffix(d)}")
        for d in (*windows, ALL_TIME)
    ]
    return shown(downloads.groupBy(*CUMULATIVE_KEYS).agg(*sums), reference, windows, null_safe_keys)


def shown(
    totals: DataFrame, reference: date | str, windows: Sequence[int], null_safe_keys: bool
) -> DataFrame:
    """Summed windows as the rollup shows them: 0 where there is nothing."""
    def window_value(days: int) -> Column:
        value = zero_if_null(F.col(f"download_count{suffix(days)}"))
        if not null_safe_keys:
            value = F.when(any_null(CUMULATIVE_KEYS), F.lit(0)).otherwise(value)
        return value.alias(f"download_count{suffix(days)}")

    return totals.select(
        date_literal(reference).alias("reference_date"),
        *CUMULATIVE_KEYS,
        *[window_value(d) for d in windows],
        f"download_count{suffix(ALL_TIME)}",
    )


def changing_days(reference: date | str, windows: Sequence[int] = WINDOWS) -> list[date]:
    """The days a rollup differs by from the one of the day before: the new
    day, and the day that falls out of each window."""
    return [ds_add(reference, 0), *(ds_add(reference, -d) for d in windows)]


def pypi_cumulative_next(
    previous: DataFrame,
    downloads: DataFrame,
    reference: date | str,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """The rollup of a date from the rollup of the day before.

    Reads the previous rollup and one date partition per window instead of all
    history: each window gains the new day and loses the day that falls out.
    Equal to :func:`pypi_cumulative` as long as no older day has changed since
    the previous rollup and no later day is present; recompute otherwise.
    """
    day, n = "download_date", F.col("download_count")
    days = [date_literal(d) for d in changing_days(reference, windows)]
    is_new = F.col(day) == date_literal(reference)

    def change(days_back: int) -> Column:
        left = F.col(day) == date_literal(ds_add(reference, -days_back))
        return F.when(is_new, n).when(left, -n).otherwise(F.lit(0))

    changes = downloads.where(F.col(day).isin(days)).select(
        *CUMULATIVE_KEYS,
        *[change(d).alias(f"download_count{suffix(d)}") for d in windows],
        F.when(is_new, n).alias(f"download_count{suffix(ALL_TIME)}"),
    )
    names = [f"download_count{suffix(d)}" for d in (*windows, ALL_TIME)]
    totals = (
        previous.select(*CUMULATIVE_KEYS, *names)
        .unionByName(changes)
        .groupBy(*CUMULATIVE_KEYS)
        .agg(*[F.sum(c).alias(c) for c in names])
    )
    return shown(totals, reference, windows, null_safe_keys=False)
