"""MERGE for Parquet datasets: update matched rows, insert the others.

Only partitions that gain, lose or change a row are rewritten. The incoming
batch and the matched keys are written to the shared scratch folder first:
they are used several times, must not change between uses, and then survive
the loss of an executor.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.operators.layout import laid_out
from tidemark.operators.sinks import overwrite_partitions
from tidemark.schemas import Table
from tidemark.sources.tables import read_partitions

PUBLISH_KEYS = (
    "download_date",
    "project",
    "project_version",
    "coalesce(python, '')",
    "coalesce(system_name, '')",
    "coalesce(country_code, '')",
)


class CardinalityViolation(ValueError):
    """A target row matches more than one source row."""


def _with_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = [f"_key{i}" for i in range(len(keys))]
    return df.withColumns(dict(zip(names, map(F.expr, keys)))), names


def _null_key(names: Sequence[str]) -> Column:
    return reduce(or_, [F.col(n).isNull() for n in names])


def left_anti_on(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys are not in ``right``. A NULL key matches
    nothing: such rows need no join, in which all would meet in one task."""
    no_key = _null_key(names)
    kept = left.where(~no_key).join(right.select(*names), list(names), "left_anti")
    return kept.unionByName(left.where(no_key))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key, the one with the highest ``order_by``, of equal ones
    that with the highest hash; rows with a NULL key all stay. An aggregate, so
    a hot key is combined before the shuffle."""
    keyed, names = _with_keys(df, keys)
    row = F.struct(*df.columns)
    tie = F.xxhash64(F.to_json(row))
    best = (
        keyed.where(~_null_key(names))
        .groupBy(*names)
        .agg(F.max_by(row, F.struct(F.col(order_by), tie)).alias("_row"))
        .select("_row.*")
    )
    return best.unionByName(keyed.where(_null_key(names)).drop(*names))


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    table: Table,
    keys: Sequence[str] | None = None,
    dedupe_by: str | None = None,
) -> None:
    """Merge ``source`` into the table at ``path``.

    ``keys`` are SQL expressions evaluated on both sides and compared with
    ``=``, so a NULL key never matches and its row is inserted. Source rows
    that match no target row are all inserted, duplicates included; two source
    rows for one target row raise, unless ``dedupe_by`` names the column whose
    highest value wins.
    """
    keys = list(keys or table.keys)
    if dedupe_by is not None:
        source = latest_per_key(source, keys, dedupe_by)
    stage = storage.scratch(spark, "upsert")
    try:
        _merge(spark, source, path, table, keys, stage)
    finally:
        storage.delete_tree(spark, stage)


def _merge(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    table: Table,
    keys: list[str],
    stage: str,
) -> None:
    part = table.partition
    if not storage.any_partition(spark, path, part):
        overwrite_partitions(source, path, table)
        return
    laid_out(source, table).write.parquet(f"{stage}/source")
    staged = spark.read.schema(table.stored_schema).parquet(f"{stage}/source")
    batch, names = _with_keys(staged, keys)
    incoming = _values(batch, part)

    # A partition column among the keys confines matches to the batch's own
    # partitions; otherwise a row may match, and leave, any of them.
    if part in keys:
        candidates = read_partitions(spark, path, table, incoming)
    else:
        candidates = _within_keys(spark.read.schema(table.stored_schema).parquet(path), batch, keys)
    target, _ = _with_keys(candidates, keys)
    per_key = batch.where(~_null_key(names)).groupBy(*names).agg(
        F.count("*").alias("_sources"), F.max(_digest(table)).alias("_source")
    )
    (
        target.select(*names, part, _digest(table).alias("_target"))
        .join(per_key, names)
        .groupBy(*names, part)
        .agg(
            F.count("*").alias("_targets"),
            F.max("_sources").alias("_sources"),
            F.bool_or(F.col("_target") != F.col("_source")).alias("_changed"),
        )
        .write.parquet(f"{stage}/matched")
    )
    matched = spark.read.parquet(f"{stage}/matched")
    if not matched.where(F.col("_sources") > 1).isEmpty():
        raise CardinalityViolation(f"several source rows match one row of {table.name}")

    # Rows that are in the table as they are need nothing: what is new and what
    # is different goes on, and only its partitions are read and written.
    same = matched.groupBy(*names).agg(F.bool_or("_changed").alias("_changed")).where("NOT _changed")
    alike = same.count()
    if alike == batch.count():
        return
    if alike:
        left_anti_on(batch, same, names).select(*table.stored_schema.names).write.parquet(f"{stage}/changed")
        changed = spark.read.schema(table.stored_schema).parquet(f"{stage}/changed")
        batch, _ = _with_keys(changed, keys)
        incoming = _values(batch, part)
        matched = left_anti_on(matched, same, names)

    # Partitions that rows leave for another one, and those that all rows leave.
    matches = matched.groupBy(part).agg(F.sum("_targets").alias("n")).collect()
    leaving = {row[part]: row["n"] for row in matches if row[part] not in incoming}
    held = read_partitions(spark, path, table, leaving).groupBy(part).agg(F.count("*").alias("n"))
    emptied = [row[part] for row in held.collect() if row["n"] == leaving[row[part]]]

    touched = read_partitions(spark, path, table, [*incoming, *leaving])
    inserted = left_anti_on(batch, matched, names)
    merged = _updated(touched, batch, keys, table).unionByName(
        inserted.select(*table.schema.names)
    )
    overwrite_partitions(merged, path, table, gather=len(incoming) + len(leaving) > 1)
    for value in emptied:
        storage.delete_tree(spark, storage.partition_dir(path, part, value))


def _within_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows between the least and the greatest key of the batch, for every
    key that is a plain column: row groups without any are not read."""
    plain = [k for k in keys if k in target.columns]
    if not plain:
        return target
    row = batch.agg(*[f(k).alias(f"{f.__name__}{i}") for i, k in enumerate(plain) for f in (F.min, F.max)]).first()
    for i, k in enumerate(plain):
        target = target.where(F.col(k).between(F.lit(row[f"min{i}"]), F.lit(row[f"max{i}"])))
    return target


def _digest(table: Table) -> Column:
    """256 bits that differ for rows that differ. Times are written to the
    microsecond; rows that only look different, such as maps in another order,
    are taken as changed."""
    exact = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    return F.sha2(F.to_json(F.struct(*table.schema.names), exact), 256)


def _values(df: DataFrame, column: str) -> list:
    """Distinct partition values: as many as directories, so they fit."""
    return [row[0] for row in df.select(column).distinct().collect()]


def _updated(touched: DataFrame, batch: DataFrame, keys: list[str], table: Table) -> DataFrame:
    """Target rows with the values of their source row, if they have one."""
    target, names = _with_keys(touched, keys)
    no_key = _null_key(names)
    new = batch.where(~no_key).select(*names, F.struct(*table.schema.names).alias("_new"))
    joined = target.where(~no_key).join(new, names, "left")
    row = F.coalesce(F.col("_new"), F.struct(*table.schema.names))
    changed = joined.select(row.alias("_row")).select("_row.*")
    return changed.unionByName(target.where(no_key).select(*table.schema.names))


def catalog_merge(source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """Both parts of a merge on a catalog table: the source, its columns under
    names that the target does not have, and the condition. In that, the keys
    are expressions of the target's columns, so they need no qualifier."""
    keyed, names = _with_keys(source, keys)
    renamed = keyed.select(*names, *[F.col(c).alias(f"_new_{c}") for c in source.columns])
    return renamed, reduce(and_, [F.expr(k) == F.col(n) for k, n in zip(keys, names)])


def merge_into_catalog(
    source: DataFrame, target: str, keys: Sequence[str], dedupe_by: str | None = None
) -> None:
    """The same merge, with the same keys, on a catalog table that supports
    row-level operations."""
    if dedupe_by is not None:
        source = latest_per_key(source, keys, dedupe_by)
    renamed, on = catalog_merge(source, keys)
    values = {c: F.col(f"_new_{c}") for c in source.columns}
    merge = renamed.mergeInto(target, on)
    merge.whenMatched().update(values).whenNotMatched().insert(values).merge()
