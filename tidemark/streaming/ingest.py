"""Raw files into the content tables, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.sinks import create_table
from tidemark.operators.upsert import upsert
from tidemark.plans.content import TABLES, prepared
from tidemark.sources.json_lines import RECORDS, records_folder, validated


def ingest_new_files(
    spark: SparkSession,
    source_dir: str,
    kind: str,
    path: str,
    checkpoint: str,
    archive_dir: str | None = None,
    max_files: int | None = None,
    files: str | None = None,
    dedupe_by: str | None = "_fetched_iso_utc",
) -> StreamingQuery:
    """Merge the files that arrived since the last run and stop.

    ``source_dir`` is the root that ``ingest_records`` writes to, and its valid
    records are read; with ``files``, a name pattern, it is any folder, read
    with all below it. The checkpoint remembers which files are done.
    ``max_files`` bounds a batch. Pending days overlap, so of several records of
    an id the one fetched last counts (``dedupe_by``); then a batch that is
    repeated after a failure merges to the same table. With ``archive_dir`` a
    finished file is moved there by the next run.
    """
    kept = files is None
    if kept:
        source_dir, files = records_folder(source_dir, kind, "valid", "*"), "part-*"
    table = TABLES[kind]
    create_table(spark, path, table)
    reader = (
        spark.readStream.schema(RECORDS[kind])
        .option("pathGlobFilter", files)
        .option("recursiveFileLookup", "true")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        rows = validated(batch) if kept else batch
        upsert(batch.sparkSession, prepared(rows, kind), path, table, dedupe_by=dedupe_by)

    return (
        reader.json(source_dir)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
