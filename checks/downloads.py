"""Queries over download events and daily downloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as b
from checks import sql
from checks.registry import query
from tidemark import storage
from tidemark.functions import dates, nulls
from tidemark.operators import audit, layout, windows
from tidemark.operators.downloads import agg_daily_downloads, agg_daily_project, flatten_events
from tidemark.plans.downloads import audit_downloads
from tidemark.schemas import CUMULATIVE_DOWNLOADS, DOWNLOADS, quarantine_of
from tidemark.sources.dimensions import package_names
from tidemark.sources.events import project_list, scan_raw_events
from tidemark.sources.tables import scan_table

_NESTED = """ts AS "timestamp", project, project_version, python, system_name, country_code"""
_IN_RANGE = f"ts >= '{b.EVENT_START}' AND ts < '{b.EVENT_END}'"
_IN_PROJECTS = f"project IN ({', '.join(repr(p) for p in project_list(b.EVENT_PROJECTS))})"


def _flat(events: DataFrame) -> DataFrame:
    return events.select(
        "timestamp",
        "project",
        F.col("file.version").alias("project_version"),
        F.col("details.python").alias("python"),
        F.col("details.system.name").alias("system_name"),
        "country_code",
    )


def event_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as daily downloads: 30 days, with NULL systems and countries."""
    events = b.raw_events(spark, sf_dir)
    return flatten_events(events).groupBy(
        "download_date", "project", "project_version", "python", "system_name", "country_code"
    ).agg(F.count("project").alias("download_count"))


# --- scans and filters -------------------------------------------------------


@query(
    "scan_raw_events",
    sql.select(sql.EVENTS, f"SELECT {_NESTED} FROM ev WHERE {_IN_PROJECTS} AND {_IN_RANGE}"),
)
def scan_raw_events_(spark, sf_dir):
    events = b.raw_events(spark, sf_dir)
    return _flat(scan_raw_events(events, b.EVENT_START, b.EVENT_END, b.EVENT_PROJECTS))


@query(
    "scan_raw_events_instants",
    sql.select(sql.EVENTS, f"SELECT {_NESTED} FROM ev WHERE {_IN_PROJECTS} AND {_IN_RANGE}"),
)
def scan_raw_events_instants(spark, sf_dir):
    """The same with event times as TIMESTAMP, which days must be UTC for."""
    events = b.raw_events(spark, sf_dir)
    seconds = F.timestamp_micros(F.unix_micros(F.to_utc_timestamp(F.col("timestamp").cast("timestamp"), "UTC")))
    found = scan_raw_events(events.withColumn("timestamp", seconds), b.EVENT_START, b.EVENT_END, b.EVENT_PROJECTS)
    return _flat(found)


@query("struct_field_access", sql.select(sql.EVENTS, f"SELECT {_NESTED} FROM ev"))
def struct_field_access(spark, sf_dir):
    return _flat(b.raw_events(spark, sf_dir))


@query(
    "filter_project_eq",
    sql.select(sql.EVENTS, f"SELECT {_NESTED} FROM ev WHERE project = 'purchase'"),
)
def filter_project_eq(spark, sf_dir):
    return _flat(b.raw_events(spark, sf_dir).where(F.col("project").isin(project_list("purchase"))))


@query("filter_project_in", sql.select(sql.EVENTS, f"SELECT {_NESTED} FROM ev WHERE {_IN_PROJECTS}"))
def filter_project_in(spark, sf_dir):
    wanted = project_list(b.EVENT_PROJECTS)
    return _flat(b.raw_events(spark, sf_dir).where(F.col("project").isin(wanted)))


@query(
    "filter_day_halfopen",
    sql.select(sql.EVENTS, "SELECT " + _NESTED + " FROM ev WHERE ts::DATE >= DATE '2024-01-10'"
               " AND ts::DATE < DATE '2024-01-11'"),
)
def filter_day_halfopen(spark, sf_dir):
    day = dates.on_day_of(F.col("timestamp"), "2024-01-10", "2024-01-11")
    return _flat(b.raw_events(spark, sf_dir).where(day))


@query("fn_date_trunc_day", "SELECT event_id, ts::DATE AS download_date FROM events")
def fn_date_trunc_day(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("download_date")
    )


@query(
    "filter_trailing_window",
    sql.select(sql.DOWNLOADS, f"SELECT * FROM dl WHERE {sql.in_window('download_date', b.REFERENCE, 30)}"),
)
def filter_trailing_window(spark, sf_dir):
    return windows.window_rows(b.downloads(spark, sf_dir), "download_date", b.REFERENCE, 30)


@query(
    "filter_date_eq",
    sql.select(sql.DOWNLOADS, f"SELECT * FROM dl WHERE download_date = DATE '{b.REFERENCE}'"),
)
def filter_date_eq(spark, sf_dir):
    rows = b.downloads(spark, sf_dir)
    return rows.where(F.col("download_date") == dates.date_literal(b.REFERENCE))


@query(
    "filter_date_le",
    sql.select(sql.DOWNLOADS, "SELECT * FROM dl WHERE download_date <= DATE '1998-06-30'"),
)
def filter_date_le(spark, sf_dir):
    rows = b.downloads(spark, sf_dir)
    return rows.where(F.col("download_date") <= dates.date_literal("1998-06-30"))


@query(
    "coalesce_keys",
    sql.select(
        sql.EVENT_DOWNLOADS,
        "SELECT project, COALESCE(system_name, '') AS system_name,"
        " COALESCE(country_code, '') AS country_code, SUM(download_count)::BIGINT AS download_count"
        " FROM evd GROUP BY 1, 2, 3",
    ),
)
def coalesce_keys(spark, sf_dir):
    named = event_downloads(spark, sf_dir).withColumns(
        {c: nulls.blank_if_null(F.col(c)) for c in ("system_name", "country_code")}
    )
    return named.groupBy("project", "system_name", "country_code").agg(
        F.sum("download_count").alias("download_count")
    )


@query(
    "coalesce_zero",
    sql.select(
        sql.DOWNLOADS,
        "SELECT project, project_version, COALESCE(SUM(download_count) FILTER (WHERE "
        f"{sql.in_window('download_date', b.REFERENCE, 7)}), 0)::BIGINT AS download_count_last_7_days"
        " FROM dl GROUP BY 1, 2",
    ),
)
def coalesce_zero(spark, sf_dir):
    week = F.sum(windows.within("download_date", b.REFERENCE, 7, F.col("download_count")))
    return (
        b.download_rows(spark, sf_dir)
        .groupBy("project", "project_version")
        .agg(nulls.zero_if_null(week).alias("download_count_last_7_days"))
    )


@query(
    "distinct_package_set",
    sql.select(
        sql.BRANDS,
        "SELECT DISTINCT pypi_project_name AS project FROM brands WHERE pypi_project_name IS NOT NULL",
    ),
)
def distinct_package_set(spark, sf_dir):
    return package_names(b.tracked_brands(spark, sf_dir))


# --- aggregates --------------------------------------------------------------


@query(
    "agg_daily_downloads",
    sql.select(
        sql.EVENTS,
        f"SELECT ts::DATE AS download_date, project, project_version, python, system_name,"
        f" country_code, COUNT(project) AS download_count FROM ev WHERE {_IN_PROJECTS} AND {_IN_RANGE}"
        " GROUP BY ALL",
    ),
)
def agg_daily_downloads_(spark, sf_dir):
    events = b.raw_events(spark, sf_dir)
    return agg_daily_downloads(events, b.EVENT_START, b.EVENT_END, b.EVENT_PROJECTS)


def _register_window_sums() -> None:
    for days in (*windows.WINDOWS, windows.ALL_TIME):
        condition = sql.in_window("download_date", b.REFERENCE, days)
        body = (
            "SELECT project, project_version, country_code, SUM(download_count)::BIGINT AS"
            f" download_count FROM dl WHERE {condition} GROUP BY 1, 2, 3"
        )

        def run(spark, sf_dir, days=days):
            return windows.window_sum(b.download_rows(spark, sf_dir), b.REFERENCE, days)

        query(f"agg_window_sum_{days or 'all'}", sql.select(sql.DOWNLOADS, body))(run)


_register_window_sums()


@query(
    "pypi_cumulative",
    sql.select(f"{sql.DOWNLOADS}, {sql.right_join_chain('dl')}", "SELECT * FROM chain"),
)
def pypi_cumulative_(spark, sf_dir):
    return windows.pypi_cumulative(b.download_rows(spark, sf_dir), b.REFERENCE)


@query(
    "join_right_chain",
    sql.select(
        f"{sql.EVENT_DOWNLOADS}, {sql.right_join_chain('evd', '2024-01-20')}", "SELECT * FROM chain"
    ),
)
def join_right_chain(spark, sf_dir):
    """The result of the chain of right joins, on keys with NULL parts and
    dates after the reference, without the joins."""
    return windows.pypi_cumulative(event_downloads(spark, sf_dir), "2024-01-20")


@query(
    "pypi_cumulative_next",
    sql.select(
        f"{sql.EVENT_DOWNLOADS}, {sql.right_join_chain('evd', '2024-01-30')}", "SELECT * FROM chain"
    ),
)
def pypi_cumulative_next_(spark, sf_dir):
    """A day's rollup out of the rollup of the day before."""
    rows = event_downloads(spark, sf_dir)
    before = windows.pypi_cumulative(rows, "2024-01-29", bounded_all_time=True)
    return windows.pypi_cumulative_next(before, rows, "2024-01-30")


@query(
    "conform_to_sink",
    sql.select(
        f"{sql.EVENT_DOWNLOADS}, {sql.right_join_chain('evd', '2024-01-20')}",
        "SELECT reference_date, project, project_version, country_code, "
        + ", ".join(
            f"download_count{sql.suffix(d)}::INTEGER AS download_count{sql.suffix(d)}"
            for d in sql.WINDOWS
        )
        + " FROM chain",
    ),
)
def conform_to_sink(spark, sf_dir):
    rollup = windows.pypi_cumulative(event_downloads(spark, sf_dir), "2024-01-20")
    return layout.conform(rollup, CUMULATIVE_DOWNLOADS.schema)


@query(
    "agg_daily_project",
    sql.select(
        sql.DOWNLOADS,
        "SELECT download_date, project, SUM(download_count)::BIGINT AS download_count FROM dl"
        f" WHERE download_date <= DATE '{b.REFERENCE}' GROUP BY 1, 2",
    ),
)
def agg_daily_project_(spark, sf_dir):
    return agg_daily_project(b.download_rows(spark, sf_dir), b.REFERENCE)


# --- audit -------------------------------------------------------------------


@query(
    "audit_duplicates",
    sql.select(
        sql.STAGED,
        f"""SELECT {sql.KEYS}, COUNT(*) AS "count" FROM staged GROUP BY ALL HAVING COUNT(*) > 1""",
    ),
)
def audit_duplicates(spark, sf_dir):
    return audit.duplicate_keys(b.staged_lines(spark, sf_dir))


_COUNTS = ", ".join(f"COUNT(*) FILTER (WHERE {r}) AS {n}" for n, r in sql.RULES.items())
_TOTAL = " + ".join(sql.RULES)
_COUNTED = f"{sql.STAGED}, counted AS (SELECT {_COUNTS}, COUNT(*) AS row_count FROM staged)"


@query(
    "audit_rule_counts",
    sql.select(_COUNTED, f"SELECT {', '.join(sql.RULES)}, {_TOTAL} AS total_invalid, row_count FROM counted"),
)
def audit_rule_counts(spark, sf_dir):
    return audit.rule_counts(b.staged_lines(spark, sf_dir))


@query(
    "audit_invalid_ratio",
    sql.select(
        _COUNTED,
        "SELECT (SELECT COUNT(*) FROM (SELECT 1 FROM staged GROUP BY "
        f"{sql.KEYS} HAVING COUNT(*) > 1)) AS duplicate_keys, {', '.join(sql.RULES)}, {_TOTAL} AS"
        f" total_invalid, row_count, round(({_TOTAL}) / row_count::DOUBLE, 10) AS invalid_ratio FROM counted",
    ),
)
def audit_invalid_ratio(spark, sf_dir):
    report = audit.audit_report(b.staged_lines(spark, sf_dir))
    return report.withColumn("invalid_ratio", F.round("invalid_ratio", 10))


def _invalid_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{name}' AS rule FROM {source} WHERE {rule}" for name, rule in sql.RULES.items()
    )


@query("union_invalid", sql.select(sql.STAGED, _invalid_sql("staged")))
def union_invalid(spark, sf_dir):
    return audit.invalid_rows(b.staged_lines(spark, sf_dir))


def _register_rules() -> None:
    names = {
        "filter_any_null": "null_values",
        "filter_nonpositive": "download_counts",
        "filter_not_regex": "country_codes",
    }
    for key, rule in names.items():

        def run(spark, sf_dir, rule=rule):
            return b.staged_lines(spark, sf_dir).where(audit.rules()[rule])

        query(key, sql.select(sql.STAGED, f"SELECT * FROM staged WHERE {sql.RULES[rule]}"))(run)


_register_rules()


@query(
    "fn_regex_match",
    sql.select(
        sql.STAGED,
        "SELECT country_code, regexp_matches(country_code, '^[A-Z]{2}$') AS is_code,"
        " COUNT(*) AS n FROM staged GROUP BY ALL",
    ),
)
def fn_regex_match(spark, sf_dir):
    is_code = F.col("country_code").rlike(audit.COUNTRY_PATTERN).alias("is_code")
    return b.staged_lines(spark, sf_dir).groupBy("country_code", is_code).agg(F.count("*").alias("n"))


@query(
    "audit_downloads",
    sql.select(
        sql.DOWNLOADS,
        f"SELECT * EXCLUDE (rule), DATE '{b.REFERENCE}' AS run_date FROM ({_invalid_sql('dl')})",
    ),
)
def audit_downloads_(spark, sf_dir):
    """The audit of clean keys with some bad country codes: passes at a
    tolerance of a tenth, and keeps the bad rows aside."""
    path = storage.scratch(spark, "quarantine")
    wide = DOWNLOADS.widened()
    audit_downloads(b.downloads(spark, sf_dir), path, b.REFERENCE, tolerance=0.1, table=wide)
    return scan_table(spark, path, quarantine_of(wide))
