"""Download jobs: ingest, audit, publish; roll up; serve; export."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import storage
from tidemark.functions.dates import ds_add, parse_day
from tidemark.operators import ledger
from tidemark.operators.audit import TOLERANCE, AuditResult, audit
from tidemark.operators.downloads import agg_daily_downloads, agg_daily_project
from tidemark.operators.prefix import DAY, downloads_from_prefix, prefix_days, prefix_rows
from tidemark.operators.sinks import (
    append_quarantine,
    clear_table,
    compact_partition,
    create_table,
    export_clustered,
    full_refresh,
    load_serving,
    overwrite_partitions,
    replace_partition,
)
from tidemark.operators.upsert import PUBLISH_KEYS, upsert
from tidemark.operators.windows import WINDOWS, changing_days, pypi_cumulative, pypi_cumulative_next
from tidemark.schemas import (
    CUMULATIVE_DOWNLOADS,
    CUMULATIVE_KEYS,
    DAILY_PROJECT_DOWNLOADS,
    DOWNLOADS,
    STAGED_DOWNLOADS,
    Table,
    quarantine_of,
)
from tidemark.sources.tables import read_partitions, scan_table, scan_table_partition


def ingest_downloads(
    events: DataFrame,
    start: date | str,
    end: date | str,
    projects: str | Sequence[str],
    path: str,
    table: Table = STAGED_DOWNLOADS,
) -> None:
    """Aggregate raw events of a day range into a table, replacing those days.
    Nothing passes through the driver."""
    create_table(events.sparkSession, path, table)
    daily = agg_daily_downloads(events, start, end, projects)
    overwrite_partitions(daily, path, table, gather=parse_day(end) > ds_add(start, 1))


def audit_downloads(
    staged: DataFrame,
    invalid_path: str,
    run_date: date | str,
    tolerance: float = TOLERANCE,
    table: Table = DOWNLOADS,
) -> AuditResult:
    """Check the staged rows: duplicates stop the job, invalid rows are kept
    aside, and too many of them stop it as well."""
    result = audit(staged)
    result.raise_on_duplicates()
    # Also without invalid rows: a clean retry takes back what a bad run left.
    append_quarantine(result.invalid, invalid_path, run_date, quarantine_of(table))
    result.raise_on_ratio(tolerance)
    return result


def publish_staged(
    spark: SparkSession, staging_path: str, path: str, table: Table = DOWNLOADS
) -> None:
    """Merge everything staged into production and empty the staging table."""
    create_table(spark, path, table)
    staged = scan_table(spark, staging_path, table)
    upsert(spark, staged, path, table, PUBLISH_KEYS)
    clear_table(spark, staging_path, table)


def publish_downloads(
    spark: SparkSession,
    events: DataFrame,
    ds: date | str,
    projects: str | Sequence[str],
    staging_path: str,
    invalid_path: str,
    production_path: str,
    tolerance: float = TOLERANCE,
    table: Table = DOWNLOADS,
) -> AuditResult:
    """Write, audit, publish one day. A failed audit leaves production alone."""
    ingest_downloads(events, ds, ds_add(ds, 1), projects, staging_path, table)
    staged = scan_table(spark, staging_path, table)
    result = audit_downloads(staged, invalid_path, ds, tolerance, table)
    publish_staged(spark, staging_path, production_path, table)
    compact_partition(spark, production_path, table, ds)
    return result


def backfill_downloads(
    events: DataFrame,
    start: date | str,
    end: date | str,
    projects: str | Sequence[str],
    path: str,
    table: Table = DOWNLOADS,
) -> None:
    """A whole day range straight into production in one job, without audit."""
    ingest_downloads(events, start, end, projects, path, table)


def aggregate_downloads(
    spark: SparkSession,
    downloads_path: str,
    path: str,
    ds: date | str,
    downloads_table: Table = DOWNLOADS,
    table: Table = CUMULATIVE_DOWNLOADS,
    incremental: bool = False,
    prefix_path: str | None = None,
) -> None:
    """Rebuild the cumulative rollup of a date, from all history.

    ``incremental`` builds it on the rollup of the day before instead and reads
    six days of downloads. That needs the rollup and its ledger, no older day
    that was added, removed or changed since, and no later one: otherwise the
    day is built from all history.

    ``prefix_path`` builds it from a table of running sums, which is brought up
    to date first and reads the days since the first changed one; days after
    ``ds`` do not count then.
    """
    create_table(spark, path, table)
    day = parse_day(ds).isoformat()
    if prefix_path is not None:
        prefix_table = extend_prefix(spark, downloads_path, prefix_path, ds, downloads_table)
        prefix = read_partitions(spark, prefix_path, prefix_table, prefix_days(ds))
        replace_partition(downloads_from_prefix(prefix, ds), path, table, ds)
        compact_partition(spark, path, table, ds)
        return
    yesterday = ds_add(ds, -1)
    before = ledger.read(spark, ledger.place(path, yesterday.isoformat()))
    now = ledger.take(spark, downloads_path, downloads_table, before, read=incremental)
    if incremental and before is not None and day not in before and ledger.changed(before, now) <= {day}:
        then = scan_table_partition(spark, path, table, "reference_date", yesterday)
        days = read_partitions(spark, downloads_path, downloads_table, changing_days(ds))
        rollup = pypi_cumulative_next(then, days, ds)
    else:
        rollup = pypi_cumulative(scan_table(spark, downloads_path, downloads_table), ds)
    storage.delete_tree(spark, ledger.place(path, day))
    replace_partition(rollup, path, table, ds)
    compact_partition(spark, path, table, ds)
    ledger.write(spark, now, ledger.place(path, day))


def prefix_of(table: Table, day: str, keys: Sequence[str], sums: Sequence[str]) -> Table:
    """The table of running sums over a daily table. Sums are 64 bits wide."""
    kinds = {f.name: f.dataType for f in table.schema}
    fields = [T.StructField(DAY, kinds[day]), *(T.StructField(k, kinds[k]) for k in keys)]
    return Table(
        f"{table.name}_prefix", T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in sums)]), partition=DAY
    )


def extend_prefix(
    spark: SparkSession,
    path: str,
    prefix_path: str,
    ds: date | str,
    table: Table = DOWNLOADS,
    keys: Sequence[str] = CUMULATIVE_KEYS,
    sums: Sequence[str] = ("download_count",),
    kept_days: int = max(WINDOWS),
) -> Table:
    """Bring a table of running sums up to a date, and return its description.

    Days from the first one on that was added, removed or changed since the last
    call are built again, on the prefix rows of the day before: as a rule only
    the new day. Days that no window reaches any more are dropped. Where the day
    before is gone, or rows without a date have changed, all kept days are built
    from all history.
    """
    prefix_table = prefix_of(table, table.partition, keys, sums)
    create_table(spark, prefix_path, prefix_table)
    last, oldest = parse_day(ds), ds_add(ds, -kept_days)
    before = ledger.read(spark, ledger.place(prefix_path, "source")) or {}
    now = ledger.take(spark, path, table, before)
    there = {parse_day(d) for d in storage.partition_values(spark, prefix_path, DAY)}
    dated = [parse_day(d) for d in now if d is not None]
    begins = max(min(dated, default=last), oldest)
    if None in now:
        begins = oldest
    changes = ledger.changed(before, now)
    stale = [parse_day(d) for d in changes if d is not None and parse_day(d) <= last]
    needed = [ds_add(begins, i) for i in range((last - begins).days + 1)]
    first = min([*stale, *(d for d in needed if d not in there)], default=None)
    if first is not None or None in changes:
        if None in changes or first <= begins or ds_add(first, -1) not in there:
            first, then = begins, None
            rows = scan_table(spark, path, table)
        else:
            then = read_partitions(spark, prefix_path, prefix_table, [ds_add(first, -1)])
            rows = read_partitions(spark, path, table, [d for d in dated if first <= d <= last])
        # Until the new rows are there, the next call must not rely on the old.
        storage.delete_tree(spark, ledger.place(prefix_path, "source"))
        built = prefix_rows(rows, table.partition, keys, sums, first, last, then)
        overwrite_partitions(built, prefix_path, prefix_table)
        for d in there - set(needed):
            storage.delete_tree(spark, storage.partition_dir(prefix_path, DAY, d))
    ledger.write(spark, now, ledger.place(prefix_path, "source"))
    return prefix_table


def serve_downloads(
    spark: SparkSession,
    cumulative_path: str,
    downloads_path: str,
    serving_cumulative: str,
    serving_daily: str,
    ds: date | str,
    retention_days: int = 30,
    downloads_table: Table = DOWNLOADS,
    cumulative_table: Table = CUMULATIVE_DOWNLOADS,
    daily_table: Table = DAILY_PROJECT_DOWNLOADS,
) -> None:
    """Load the serving datasets: one day of the rollup with retention, and
    all daily totals up to that day."""
    create_table(spark, serving_cumulative, cumulative_table)
    snapshot = scan_table_partition(spark, cumulative_path, cumulative_table, "reference_date", ds)
    load_serving(spark, snapshot, serving_cumulative, cumulative_table, ds, retention_days)
    daily = agg_daily_project(scan_table(spark, downloads_path, downloads_table), ds)
    full_refresh(daily, serving_daily, daily_table)


def export_dashboard(
    spark: SparkSession,
    downloads_path: str,
    path: str,
    ds: date | str,
    partitions: int | None = None,
    table: Table = DOWNLOADS,
) -> str:
    """The production table as clustered Parquet for the dashboard."""
    return export_clustered(scan_table(spark, downloads_path, table), path, ds, partitions)
