"""Raw download events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import on_day_of


def project_list(projects: str | Sequence[str]) -> list[str]:
    """A job's project parameter: one name, a comma list, or a sequence."""
    if isinstance(projects, str):
        return [p.strip() for p in projects.split(",")]
    return list(projects)


def is_instant(events: DataFrame) -> bool:
    """Whether event times are instants, or wall times in UTC."""
    return isinstance(events.schema["timestamp"].dataType, T.TimestampType)


def scan_raw_events(
    events: DataFrame, start: date | str, end: date | str, projects: str | Sequence[str]
) -> DataFrame:
    """Events of some projects in the half-open range ``[start, end)`` of UTC days.

    Both predicates are on bare columns, so Parquet skips row groups by them.
    """
    days = on_day_of(F.col("timestamp"), start, end, is_instant(events))
    return events.where(F.col("project").isin(project_list(projects)) & days)
