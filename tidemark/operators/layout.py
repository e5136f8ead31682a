"""How rows are laid out before they are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import Table


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in the declared types. A value that does not fit
    fails the job instead of wrapping around."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.to(schema)


def repartition_by(df: DataFrame, *columns: str, partitions: int | None = None) -> DataFrame:
    """Rows of a key together. With no fixed number the partitions are sized
    at run time: small keys share one, and a key that is too large for one is
    split, so a hot project never lands in a single task."""
    if partitions is not None:
        return df.repartition(partitions, *columns)
    return df.hint("rebalance", *columns)


def clustered(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The dashboard layout: by project, sorted by system and country."""
    return repartition_by(df, "project", partitions=partitions).sortWithinPartitions(
        "system_name", "country_code"
    )


def laid_out(df: DataFrame, table: Table) -> DataFrame:
    """Rows of a table with its directory column."""
    rows = conform(df, table.schema)
    if table.partition_sql is not None:
        rows = rows.withColumn(table.partition, F.expr(table.partition_sql))
    return rows
