"""The plain ways to compute some results, to measure the library against."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.audit import rules
from tidemark.operators.sinks import full_refresh
from tidemark.operators.windows import WINDOWS, suffix, window_sum
from tidemark.schemas import CUMULATIVE_KEYS, DOWNLOAD_KEYS, MENTIONS_TYPE, Table


def right_join_chain(downloads: DataFrame, reference) -> DataFrame:
    """The cumulative rollup as six aggregates and five right joins."""
    spans = [*WINDOWS, None]
    frames = [
        window_sum(downloads, reference, d).select(
            *[F.col(k).alias(f"{k}_{i}") for k in CUMULATIVE_KEYS],
            F.col("download_count").alias(f"n{i}"),
        )
        for i, d in enumerate(spans)
    ]
    chain = frames[0]
    for i, right in enumerate(frames[1:], 1):
        on = [F.col(f"{k}_{i - 1}") == F.col(f"{k}_{i}") for k in CUMULATIVE_KEYS]
        chain = chain.join(right, on, "right")
    last = len(spans) - 1
    return chain.select(
        F.lit(reference).cast("date").alias("reference_date"),
        *[F.coalesce(*[f"{k}_{i}" for i in range(last + 1)]).alias(k) for k in CUMULATIVE_KEYS],
        *[
            F.coalesce(F.col(f"n{i}"), F.lit(0)).alias(f"download_count{suffix(d)}")
            for i, d in enumerate(spans[:-1])
        ],
        F.col(f"n{last}").alias("download_count_since_first_record"),
    )


def mentions_by_regexp(df: DataFrame, projects) -> DataFrame:
    """Mentions with one regular expression for every term on every text."""
    counts = []
    for project in projects:
        n = F.lit(0)
        for term in project.terms:
            spaced = r"[-\s]?".join(map(re.escape, re.split(r"[-\s]+", term)))
            n = n + F.coalesce(F.regexp_count("text", F.lit(rf"(?iU)\b{spaced}\b")), F.lit(0))
        counts.append(F.struct(F.lit(project.name).alias("project"), n.cast("int").alias("mentions")))
    found = F.filter(F.array(*counts), lambda c: c["mentions"] > 0)
    return df.withColumn("projects_mentions", F.when(F.size(found) > 0, found))


def audit_in_six_actions(downloads: DataFrame) -> tuple:
    duplicates = downloads.groupBy(*DOWNLOAD_KEYS).count().where("count > 1").count()
    counts = [downloads.where(rule).count() for rule in rules().values()]
    invalid = None
    for rule in rules().values():
        part = downloads.where(rule)
        invalid = part if invalid is None else invalid.union(part)
    return duplicates, *counts, invalid.count(), downloads.count()


def rewrite_with(spark: SparkSession, source: DataFrame, path: str, new_path: str, table: Table, keys) -> None:
    """A merge that rewrites the whole table."""
    target = spark.read.schema(table.stored_schema).parquet(path)
    on = [F.expr(k) for k in keys]
    names = [f"_k{i}" for i in range(len(on))]
    left = target.withColumns(dict(zip(names, on)))
    right = source.withColumns(dict(zip(names, on))).select(*names)
    kept = left.join(right, names, "left_anti").select(*table.schema.names)
    full_refresh(kept.unionByName(source.select(*table.schema.names)), new_path, table)
