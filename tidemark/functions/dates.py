"""Dates: run-date arithmetic on the driver, day predicates on the executors.

Predicates compare the bare column with a literal so that they reach the
Parquet reader and prune date partitions.
"""

from __future__ import annotations

from datetime import UTC, date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS_PER_DAY = 86_400


def parse_day(day: date | str) -> date:
    if isinstance(day, datetime):
        return day.date()
    return day if isinstance(day, date) else date.fromisoformat(day)


def ds_add(day: date | str, days: int) -> date:
    """The run date shifted by some days."""
    return parse_day(day) + timedelta(days=days)


def date_literal(day: date | str) -> Column:
    return F.lit(parse_day(day))


def midnight(day: date | str, instant: bool) -> Column:
    """The start of a UTC day: an instant, which no session time zone moves, or
    for timestamps without a zone the day's wall time."""
    if instant:
        return F.lit(datetime.combine(parse_day(day), time(), tzinfo=UTC))
    return date_literal(day)


def on_day_of(ts: Column, start: date | str, end: date | str, instant: bool = False) -> Column:
    """Half-open UTC day range on a raw timestamp; equal to comparing its day.
    ``instant`` says that the column is a TIMESTAMP, not a TIMESTAMP_NTZ."""
    return (ts >= midnight(start, instant)) & (ts < midnight(end, instant))


def utc_day(ts: Column, instant: bool = False) -> Column:
    """The UTC day of a raw timestamp, in any session time zone."""
    if not instant:
        return F.to_date(ts)
    days = F.floor(F.unix_micros(ts) / F.lit(_SECONDS_PER_DAY * 1e6)).cast("int")
    return F.date_add(F.lit(date(1970, 1, 1)), days)


def in_trailing_window(day: Column, reference: date | str, days: int) -> Column:
    """The ``days`` days that end with the reference date, both included."""
    return day.between(date_literal(ds_add(reference, 1 - days)), date_literal(reference))


def epoch_to_date(seconds: Column) -> Column:
    """Epoch seconds (with fraction) to the UTC date, in any session time zone."""
    days = F.floor(seconds / F.lit(float(_SECONDS_PER_DAY))).cast("int")
    return F.date_add(F.lit(date(1970, 1, 1)), days)


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def fetch_metadata(fetched_at: datetime) -> dict[str, Column]:
    """Fetch time as the two text columns that records carry."""
    return {
        "_fetched_date": F.lit(fetched_at.date().isoformat()),
        "_fetched_iso_utc": F.lit(fetched_at.isoformat()),
    }
