"""Writing the tables. One writer per table at a time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import storage
from tidemark.functions.dates import date_literal, ds_add, parse_day
from tidemark.operators.layout import clustered, conform, laid_out, repartition_by
from tidemark.schemas import INVALID_DOWNLOADS, Table
from tidemark.sources.tables import read_partitions

TARGET_FILE_BYTES = 128 * 1024 * 1024


def create_table(spark: SparkSession, path: str, table: Table) -> None:
    """An empty dataset, unless the path is already there."""
    if not storage.exists(spark, path):
        empty = spark.createDataFrame([], table.stored_schema).write
        (empty.partitionBy(table.partition) if table.partition else empty).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, table: Table, *, gather: bool = True) -> None:
    """Replace exactly the partitions that occur in the new rows; no rows, no
    change. Rows are gathered by partition first, so a partition gets few
    files however many tasks its rows come from. Rows of a single partition
    need no such shuffle: pass ``gather=False`` for them."""
    rows = laid_out(df, table)
    _write_partitions(repartition_by(rows, table.partition) if gather else rows, path, table)


def _write_partitions(rows: DataFrame, path: str, table: Table) -> None:
    if table.sort:
        # Row groups of few days and ids: readers skip the others.
        rows = rows.sortWithinPartitions(table.partition, *table.sort)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(table.partition)
        .parquet(path)
    )


def _day_of(table: Table, value: date | str) -> date:
    """The day of a partition. Only tables with a directory for each day have
    such a thing."""
    if table.partition is None or table.partition_sql is not None:
        raise ValueError(f"{table.name} has no partition for each day")
    return parse_day(value)


def replace_partition(df: DataFrame, path: str, table: Table, value: date | str) -> None:
    """Rebuild one date: its directory holds exactly the new rows afterwards,
    also when there are none. Running it again changes nothing. A row of
    another date fails the job: it would be lost."""
    day = _day_of(table, value)
    column = F.col(table.partition)
    strange = F.concat(F.lit(f"{table.name}: a row of "), F.coalesce(column.cast("string"), F.lit("no date")), F.lit(f" among those of {day}"))
    rows = conform(df, table.schema).where(
        F.when(column == date_literal(day), F.lit(True)).otherwise(F.raise_error(strange).cast("boolean"))
    )
    rows.drop(table.partition).write.mode("overwrite").parquet(
        storage.partition_dir(path, table.partition, day.isoformat())
    )


def full_refresh(df: DataFrame, path: str, table: Table) -> None:
    """Replace every row of a table."""
    writer = laid_out(df, table).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(table.partition) if table.partition else writer).parquet(path)


def clear_table(spark: SparkSession, path: str, table: Table) -> None:
    """Empty a table, e.g. staging after its rows are published."""
    full_refresh(spark.createDataFrame([], table.schema), path, table)


def append_quarantine(
    invalid: DataFrame, path: str, run_date: date | str, table: Table = INVALID_DOWNLOADS
) -> None:
    """Keep a run's invalid rows. A run owns one partition, so a retry
    replaces its rows instead of adding them again."""
    rows = invalid.withColumn("run_date", date_literal(run_date))
    replace_partition(rows, path, table, run_date)


def export_clustered(
    df: DataFrame, path: str, ds: date | str, partitions: int | None = None
) -> str:
    """Parquet for the dashboard under ``path/ds``; returns that folder."""
    target = f"{path}/{parse_day(ds).isoformat()}"
    clustered(df, partitions).write.mode("overwrite").parquet(target)
    return target


def compact_partition(
    spark: SparkSession,
    path: str,
    table: Table,
    value: date | str,
    target_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Merge one partition's small files into files near a target size, without
    a shuffle. Returns how many files it wrote; 0 if there was nothing to merge.

    Files of at least half the target keep their names and times: only smaller
    ones are read and rewritten, so that what late rows cost follows their
    number and not the day's. The new files are whole, and a note of those they
    stand for is written, before anything is deleted; a run that ends in between
    is completed by the next one. As with every write here, readers in that
    moment may miss rows.
    """
    day = _day_of(table, value).isoformat()
    folder = storage.partition_dir(path, table.partition, day)
    _finish_compaction(spark, folder)
    small = {f: n for f, n in storage.files(spark, f"{folder}/part-*").items() if 2 * n < target_bytes}
    files = -(-sum(small.values()) // target_bytes)
    if len(small) <= files:
        return 0
    inside = T.StructType([f for f in table.stored_schema if f.name != table.partition])
    rows = spark.read.schema(inside).parquet(*small).coalesce(files)
    if table.sort:
        rows = rows.sortWithinPartitions(*table.sort)
    rows.write.mode("overwrite").parquet(f"{folder}/{_MERGED}")
    storage.write_text(spark, f"{folder}/{_REPLACED}", "\n".join(small))
    return _finish_compaction(spark, folder)


# Readers pass over names that begin with an underscore.
_MERGED, _REPLACED = "_merged", "_replaced"


def _finish_compaction(spark: SparkSession, folder: str) -> int:
    """Puts merged files in the place of those they stand for, as far as that
    has not been done; without a note of these the merge did not end."""
    merged, note = f"{folder}/{_MERGED}", f"{folder}/{_REPLACED}"
    moved = []
    if storage.exists(spark, note):
        for file in storage.read_text(spark, note).split("\n"):
            storage.delete_tree(spark, file)
        moved = storage.glob(spark, f"{merged}/part-*")
        for file in moved:
            storage.rename(spark, file, f"{folder}/{file.rsplit('/', 1)[1]}")
        storage.delete_tree(spark, note)
    storage.delete_tree(spark, merged)
    return len(moved)


def drop_expired(
    spark: SparkSession, path: str, table: Table, ds: date | str, retention_days: int
) -> list[str]:
    """Delete whole partitions older than ``ds - retention_days``; returns them."""
    cutoff = ds_add(ds, -retention_days).isoformat()
    expired = [
        value
        for value in storage.partition_values(spark, path, table.partition)
        if value < cutoff
    ]
    for value in expired:
        storage.delete_tree(spark, storage.partition_dir(path, table.partition, value))
    return expired


def within_retention(df: DataFrame, column: str, ds: date | str, retention_days: int) -> DataFrame:
    """The same cut as a filter on read."""
    return df.where(F.col(column) >= date_literal(ds_add(ds, -retention_days)))


def load_serving(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    table: Table,
    ds: date | str,
    retention_days: int = 30,
) -> None:
    """One day into the serving dataset: clear it there, insert it, and drop
    the days past retention."""
    replace_partition(df, path, table, ds)
    drop_expired(spark, path, table, ds, retention_days)
