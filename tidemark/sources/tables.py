"""Reading the lakehouse's tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.functions.dates import date_literal, parse_day
from tidemark.schemas import Table


def scan_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The whole table. The declared schema is used, not one inferred from
    files or directory names; a computed partition column is not shown."""
    stored = spark.read.schema(table.stored_schema).parquet(path)
    return stored.select(*table.schema.names)


def read_partitions(
    spark: SparkSession, path: str, table: Table, values: Iterable
) -> DataFrame:
    """Some partitions, with the partition column. Only their directories are
    listed: a table of many years lists its other days for nothing."""
    wanted = (storage.partition_dir(path, table.partition, value) for value in values)
    there = [folder for folder in wanted if storage.exists(spark, folder)]
    if not there:
        return spark.createDataFrame([], table.stored_schema)
    return spark.read.schema(table.stored_schema).option("basePath", path).parquet(*there)


def scan_table_partition(
    spark: SparkSession, path: str, table: Table, column: str, day: date | str
) -> DataFrame:
    """The rows of one day, reading only that day's (or month's) directory."""
    in_month = table.partition_sql is not None
    value = parse_day(day).strftime("%Y-%m") if in_month else parse_day(day).isoformat()
    stored = read_partitions(spark, path, table, [value])
    return stored.where(F.col(column) == date_literal(day)).select(*table.schema.names)
