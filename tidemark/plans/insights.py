"""Derived questions about the rollups. They follow from the tables' purpose;
each is one aggregation and at most one window over its small result."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import date_literal, ds_add, month_of


def project_categories(projects: DataFrame) -> DataFrame:
    """Package name with each of its categories, blanks trimmed."""
    return projects.where(F.col("pypi_project_name").isNotNull()).select(
        F.col("pypi_project_name").alias("project"),
        F.explode(F.transform("project_categories", F.trim)).alias("category"),
    )


def per_project(downloads: DataFrame, *columns) -> DataFrame:
    """Downloads per project (and more columns), before any join: the join with
    categories then multiplies totals, not rows."""
    return downloads.groupBy("project", *columns).agg(F.sum("download_count").alias("download_count"))


def popularity_by_category(downloads: DataFrame, projects: DataFrame) -> DataFrame:
    """Projects ranked by downloads within each category."""
    ranked = Window.partitionBy("category").orderBy(F.desc("download_count"), "project")
    return (
        per_project(downloads)
        .join(project_categories(projects), "project")
        .withColumn("popularity_rank", F.rank().over(ranked))
        .select("category", "project", "download_count", "popularity_rank")
    )


def adoption_rate(downloads: DataFrame, reference: date | str, days: int = 30) -> DataFrame:
    """The last ``days`` days against the ``days`` before; NULL without a base."""
    start, middle = ds_add(reference, 1 - 2 * days), ds_add(reference, 1 - days)
    recent = F.col("download_date") >= date_literal(middle)
    n = F.col("download_count")
    return (
        downloads.where(F.col("download_date").between(date_literal(start), date_literal(reference)))
        .groupBy("project")
        .agg(
            F.coalesce(F.sum(F.when(recent, n)), F.lit(0)).alias("recent_count"),
            F.coalesce(F.sum(F.when(~recent, n)), F.lit(0)).alias("base_count"),
        )
        .withColumn(
            "adoption_rate",
            F.when(F.col("base_count") > 0, F.col("recent_count") / F.col("base_count")),
        )
    )


def category_trend(downloads: DataFrame, projects: DataFrame) -> DataFrame:
    """Monthly downloads per category and project, and the change from the
    month before in which the project has any."""
    months = per_project(
        downloads.withColumn("month", month_of(F.col("download_date"))), "month"
    ).join(project_categories(projects), "project")
    by_month = Window.partitionBy("category", "project").orderBy("month")
    return months.select(
        "category",
        "project",
        "month",
        "download_count",
        (F.col("download_count") - F.lag("download_count").over(by_month)).alias("change"),
    )


def leader_then_now(
    downloads: DataFrame,
    projects: DataFrame,
    then: date | str,
    now: date | str,
    days: int = 365,
) -> DataFrame:
    """The most downloaded project of each category in the ``days`` days up to
    two dates, from one scan of both."""

    def span(reference: date | str):
        day = F.col("download_date")
        return day.between(date_literal(ds_add(reference, 1 - days)), date_literal(reference))

    n = F.col("download_count")
    totals = (
        downloads.where(span(then) | span(now))
        .groupBy("project")
        .agg(F.sum(F.when(span(then), n)).alias("then"), F.sum(F.when(span(now), n)).alias("now"))
        .join(project_categories(projects), "project")
    )

    return totals.groupBy("category").agg(*_leaders("then"), *_leaders("now"))


def _leaders(column: str):
    """Leader and its total: the least of (minus total, name), NULLs left out."""
    best = F.min(F.when(F.col(column).isNotNull(), F.struct((-F.col(column)).alias("less"), F.col("project"))))
    return best["project"].alias(f"leader_{column}"), (-best["less"]).alias(f"downloads_{column}")
