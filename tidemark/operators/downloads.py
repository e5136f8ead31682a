"""Download counts: daily aggregation of raw events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_literal, utc_day
from tidemark.schemas import DOWNLOAD_KEYS
from tidemark.sources.events import is_instant, scan_raw_events


def flatten_events(events: DataFrame) -> DataFrame:
    """The nested fields the counts are grouped by, under their table names."""
    return events.select(
        utc_day(F.col("timestamp"), is_instant(events)).alias("download_date"),
        "project",
        F.col("file.version").alias("project_version"),
        F.col("details.python").alias("python"),
        F.col("details.system.name").alias("system_name"),
        "country_code",
    )


def agg_daily_downloads(
    events: DataFrame, start: date | str, end: date | str, projects: str | Sequence[str]
) -> DataFrame:
    """Downloads per day and key. Map-side counts keep a hot key to one row
    per task before the shuffle."""
    wanted = flatten_events(scan_raw_events(events, start, end, projects))
    return wanted.groupBy(*DOWNLOAD_KEYS).agg(F.count("project").alias("download_count"))


def agg_daily_project(downloads: DataFrame, ds: date | str) -> DataFrame:
    """Downloads per day and project up to a day."""
    return (
        downloads.where(F.col("download_date") <= date_literal(ds))
        .groupBy("download_date", "project")
        .agg(F.sum("download_count").alias("download_count"))
    )
