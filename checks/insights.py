"""Queries of the derived questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks import sql
from checks.registry import query
from tidemark.plans import insights

_CTES = f"{sql.DOWNLOADS}, {sql.BRAND_CATEGORIES}"


@query(
    "q_popularity_by_category",
    sql.select(
        _CTES,
        "SELECT category, d.project, SUM(download_count)::BIGINT AS download_count,"
        " (rank() OVER (PARTITION BY category ORDER BY SUM(download_count) DESC, d.project))::INTEGER"
        " AS popularity_rank FROM dl d JOIN categories c ON d.project = c.project GROUP BY 1, 2",
    ),
)
def q_popularity_by_category(spark, sf_dir):
    return insights.popularity_by_category(
        b.download_rows(spark, sf_dir), b.tracked_brands(spark, sf_dir)
    )


_RECENT = "download_date BETWEEN DATE '2001-06-02' AND DATE '2001-07-01'"
_BASE = "download_date BETWEEN DATE '2001-05-03' AND DATE '2001-06-01'"


@query(
    "q_adoption_rate",
    sql.select(
        sql.DOWNLOADS,
        "SELECT project, recent_count, base_count, CASE WHEN base_count > 0 THEN"
        " round(recent_count / base_count::DOUBLE, 10) END AS adoption_rate FROM (SELECT project,"
        f" COALESCE(SUM(download_count) FILTER (WHERE {_RECENT}), 0)::BIGINT AS recent_count,"
        f" COALESCE(SUM(download_count) FILTER (WHERE {_BASE}), 0)::BIGINT AS base_count"
        f" FROM dl WHERE {_RECENT} OR {_BASE} GROUP BY project)",
    ),
)
def q_adoption_rate(spark, sf_dir):
    rates = insights.adoption_rate(b.download_rows(spark, sf_dir), b.REFERENCE)
    return rates.withColumn("adoption_rate", F.round("adoption_rate", 10))


@query(
    "q_category_trend",
    sql.select(
        f"{_CTES}, months AS (SELECT project, strftime(download_date, '%Y-%m') AS month,"
        " SUM(download_count)::BIGINT AS download_count FROM dl GROUP BY 1, 2)",
        "SELECT category, m.project, month, download_count, download_count - lag(download_count)"
        " OVER (PARTITION BY category, m.project ORDER BY month) AS change"
        " FROM months m JOIN categories c ON m.project = c.project",
    ),
)
def q_category_trend(spark, sf_dir):
    return insights.category_trend(b.download_rows(spark, sf_dir), b.tracked_brands(spark, sf_dir))


def _leader(name: str, reference: str) -> str:
    return (
        f"{name} AS (SELECT category, project, n FROM (SELECT category, d.project,"
        " SUM(download_count)::BIGINT AS n, row_number() OVER (PARTITION BY category ORDER BY"
        " SUM(download_count) DESC, d.project) AS place FROM dl d JOIN categories c"
        f" ON d.project = c.project WHERE {sql.in_window('download_date', reference, 365)}"
        " GROUP BY 1, 2) WHERE place = 1)"
    )


@query(
    "q_leader_then_now",
    sql.select(
        f"{_CTES}, {_leader('a', '1998-07-01')}, {_leader('z', b.REFERENCE)}",
        "SELECT COALESCE(a.category, z.category) AS category, a.project AS leader_then,"
        " a.n AS downloads_then, z.project AS leader_now, z.n AS downloads_now"
        " FROM a FULL JOIN z ON a.category = z.category",
    ),
)
def q_leader_then_now(spark, sf_dir):
    return insights.leader_then_now(
        b.download_rows(spark, sf_dir), b.tracked_brands(spark, sf_dir), "1998-07-01", b.REFERENCE
    )
