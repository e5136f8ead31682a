"""Forum jobs: load content, extract mentions, roll them up."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.functions.bands import Band
from tidemark.functions.dates import epoch_to_date
from tidemark.operators.mentions import find_mentions, union_content
from tidemark.operators.rollups import reddit_cumulative, reddit_daily
from tidemark.operators.score_store import fill_scores, stored_scores
from tidemark.operators.scoring import Scorer, lexicon_scorer, score_mentions
from tidemark.operators.sinks import (
    compact_partition,
    create_table,
    overwrite_partitions,
    replace_partition,
)
from tidemark.operators.upsert import upsert
from tidemark.schemas import (
    COMMENTS,
    CUMULATIVE_MENTIONS,
    DAILY_MENTIONS,
    LEGACY_COLUMNS,
    MENTIONS,
    SUBMISSIONS,
    Table,
)
from tidemark.sources.dimensions import BANDS, TRACKED, Project
from tidemark.sources.json_lines import scan_comments, scan_submissions
from tidemark.sources.tables import scan_table, scan_table_partition
from tidemark.sources.validation import check_records, record_lines, write_records

TABLES = {"submissions": SUBMISSIONS, "comments": COMMENTS}


def add_null_columns(submissions: DataFrame) -> DataFrame:
    """Two columns that records no longer carry and the table still has."""
    return submissions.withColumns({c: F.lit(None).cast("string") for c in LEGACY_COLUMNS})


def with_created_date(records: DataFrame) -> DataFrame:
    return records.withColumn("created_date", epoch_to_date(F.col("created_utc")))


def prepared(records: DataFrame, kind: str) -> DataFrame:
    """Raw records as rows of their table."""
    rows = add_null_columns(records) if kind == "submissions" else records
    return with_created_date(rows)


def ingest_records(lines: DataFrame, root: str, kind: str, fetched_at: datetime) -> None:
    """Validate raw lines and write both outcomes as JSON lines."""
    checked = check_records(lines, kind)
    kept = record_lines(checked, kind, fetched_at)
    write_records(kept, root, kind, fetched_at.date().isoformat())


def load_content(
    spark: SparkSession,
    source_dir: str,
    submissions_path: str,
    comments_path: str,
    dedupe_by: str | None = None,
    on_malformed: str = "null",
) -> None:
    """Merge valid records into the two content tables: files of a day, or the
    root that ``ingest_records`` writes to. Merged again they change nothing,
    but for lines that are no JSON: their NULL id matches nothing, and they are
    inserted each time, unless ``on_malformed`` is "drop" or "fail"."""
    for kind, scan, path in (
        ("submissions", scan_submissions, submissions_path),
        ("comments", scan_comments, comments_path),
    ):
        create_table(spark, path, TABLES[kind])
        rows = prepared(scan(spark, source_dir, on_malformed), kind)
        upsert(spark, rows, path, TABLES[kind], dedupe_by=dedupe_by)


def mentions_of(
    content: DataFrame, projects: Sequence[Project] = TRACKED, scorer: Scorer | None = None
) -> DataFrame:
    return score_mentions(find_mentions(content, projects), scorer or lexicon_scorer())


def mentions_job(
    spark: SparkSession,
    ds: date | str,
    submissions_path: str,
    comments_path: str,
    target_path: str,
    projects: Sequence[Project] = TRACKED,
    scorer: Scorer | None = None,
    scores_path: str | None = None,
    scorer_version: str | None = None,
) -> None:
    """One day's mentions and scores, overwriting that day. Texts are not
    shuffled: tasks write what they scored, and small files are merged after.

    With ``scores_path`` and ``scorer_version`` scores are kept there, and only
    texts that this version has not seen go to the scorer, each once. The
    mentions are then written to the scratch folder first, as they are used
    twice.
    """
    if (scores_path is None) != (scorer_version is None):
        raise ValueError("scores_path and scorer_version go together")
    content = union_content(
        scan_table_partition(spark, submissions_path, SUBMISSIONS, "created_date", ds),
        scan_table_partition(spark, comments_path, COMMENTS, "created_date", ds),
    )
    create_table(spark, target_path, MENTIONS)
    if scores_path is None:
        found = mentions_of(content, projects, scorer)
        overwrite_partitions(found, target_path, MENTIONS, gather=False)
    else:
        stage = storage.scratch(spark, "mentions")
        try:
            mentioned = find_mentions(content, projects)
            mentioned.write.parquet(stage)
            mentioned = spark.read.schema(mentioned.schema).parquet(stage)
            fill_scores(mentioned, scorer or lexicon_scorer(), scores_path, scorer_version)
            found = stored_scores(mentioned, scores_path, scorer_version)
            overwrite_partitions(found, target_path, MENTIONS, gather=False)
        finally:
            storage.delete_tree(spark, stage)
    compact_partition(spark, target_path, MENTIONS, ds)


def aggregate_mentions(
    spark: SparkSession,
    mentions_path: str,
    projects: DataFrame,
    daily_path: str,
    cumulative_path: str,
    ds: date | str,
    bands: Sequence[Band] = BANDS,
    daily_table: Table = DAILY_MENTIONS,
    cumulative_table: Table = CUMULATIVE_MENTIONS,
) -> None:
    """Rebuild a day's daily and cumulative rollups."""
    create_table(spark, daily_path, daily_table)
    create_table(spark, cumulative_path, cumulative_table)
    content = scan_table_partition(spark, mentions_path, MENTIONS, "created_date", ds)
    replace_partition(reddit_daily(content, bands), daily_path, daily_table, ds)
    daily = scan_table(spark, daily_path, daily_table)
    rollup = reddit_cumulative(daily, projects, bands, ds)
    replace_partition(rollup, cumulative_path, cumulative_table, ds)
    compact_partition(spark, daily_path, daily_table, ds)
    compact_partition(spark, cumulative_path, cumulative_table, ds)
