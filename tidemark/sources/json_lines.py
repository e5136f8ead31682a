"""Raw forum records: JSON lines, one object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import storage
from tidemark.functions.nulls import falsy_to_null
from tidemark.schemas import COMMENT_RECORD, SUBMISSION_RECORD

RECORDS = {"submissions": SUBMISSION_RECORD, "comments": COMMENT_RECORD}


def select_files(spark: SparkSession, prefix: str, kind: str) -> list[str]:
    """Files (or Spark-written folders) under a prefix whose names end in
    ``_<kind>.json``; or, if the prefix holds validated records, their folders
    of that kind: ``<kind>/fetched_date=…/status=valid``. A prefix that holds
    files, but none of the kind, is an error."""
    named = storage.glob(spark, f"{prefix}/*_{kind}.json")
    found = named or storage.glob(spark, records_folder(prefix, kind, "valid", "*"))
    if not found and storage.glob(spark, f"{prefix}/*"):
        raise FileNotFoundError(f"{prefix} holds no {kind}")
    return found


def records_folder(root: str, kind: str, status: str, fetched_date: str) -> str:
    """Where validated records are kept."""
    return f"{root}/{kind}/fetched_date={fetched_date}/status={status}"


def scan_json(
    spark: SparkSession, paths: list[str], schema: T.StructType, on_malformed: str = "null"
) -> DataFrame:
    """JSON lines with a declared schema and no inference pass. A value of the
    wrong type gives a NULL. A line that is no JSON gives a row of NULLs,
    ``on_malformed`` "drop" leaves it out, "fail" stops the job at either."""
    modes = {"null": "PERMISSIVE", "drop": "PERMISSIVE", "fail": "FAILFAST"}
    if on_malformed not in modes:
        raise ValueError(f"on_malformed: {on_malformed}")
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("mode", modes[on_malformed]).option("recursiveFileLookup", True)
    if on_malformed != "drop":
        return reader.schema(schema).json(paths)
    # Only text that is no JSON at all: a wrong type in one field stays a NULL.
    lines = reader.text(paths).where(F.try_parse_json("value").isNotNull())
    return lines.select(F.from_json("value", schema).alias("_r")).select("_r.*")


def validated(records: DataFrame) -> DataFrame:
    """What the tables keep of validated lines: ``edited`` is NULL for a record
    that never was."""
    return records.withColumn("edited", falsy_to_null(F.col("edited")))


def scan_records(spark: SparkSession, prefix: str, kind: str, on_malformed: str = "null") -> DataFrame:
    files = select_files(spark, prefix, kind)
    found = scan_json(spark, files, RECORDS[kind], on_malformed)
    return validated(found) if any("/status=valid" in f for f in files) else found


def scan_submissions(spark: SparkSession, prefix: str, on_malformed: str = "null") -> DataFrame:
    return scan_records(spark, prefix, "submissions", on_malformed)


def scan_comments(spark: SparkSession, prefix: str, on_malformed: str = "null") -> DataFrame:
    return scan_records(spark, prefix, "comments", on_malformed)
