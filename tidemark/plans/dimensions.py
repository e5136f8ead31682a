"""Build the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.sinks import create_table, full_refresh
from tidemark.schemas import POLARITY_CATEGORIES, TRACKED_PROJECTS, TRACKED_SUBREDDITS
from tidemark.sources.dimensions import band_rows, project_rows, subreddit_rows


def build_dims(
    spark: SparkSession,
    root: str,
    projects: DataFrame | None = None,
    subreddits: DataFrame | None = None,
    bands: DataFrame | None = None,
) -> dict[str, str]:
    """Create and refresh the three dimensions; returns their paths. Without
    arguments they hold the fixed values."""
    rows = {
        TRACKED_SUBREDDITS: subreddits if subreddits is not None else subreddit_rows(spark),
        TRACKED_PROJECTS: projects if projects is not None else project_rows(spark),
        POLARITY_CATEGORIES: bands if bands is not None else band_rows(spark),
    }
    paths = {}
    for table, df in rows.items():
        path = f"{root}/{table.name}"
        create_table(spark, path, table)
        full_refresh(df, path, table)
        paths[table.name] = path
    return paths
