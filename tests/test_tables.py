from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.operators import sinks
from tidemark.operators.layout import clustered, conform
from tidemark.operators.upsert import (
    PUBLISH_KEYS,
    CardinalityViolation,
    left_anti_on,
    merge_into_catalog,
    upsert,
)
from tidemark.schemas import ALL_TABLES, COMMENTS, CUMULATIVE_DOWNLOADS, DOWNLOADS, Table, _struct
from tidemark.schemas import _DATE, _INT, _STR
from tidemark.sources.tables import scan_table, scan_table_partition

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 2, 3)
POSTS = Table(
    "posts",
    _struct(("id text", _STR), ("score", _INT), ("created_date", _DATE)),
    partition="created_month",
    partition_sql="date_format(created_date, 'yyyy-MM')",
    keys=("id",),
)


def downloads(spark, *rows):
    return spark.createDataFrame(list(rows), DOWNLOADS.schema)


def row(day, project="p", version="1", python="3", system="L", country="US", n=1):
    return (day, project, version, python, system, country, n)


@pytest.mark.parametrize("table", ALL_TABLES, ids=lambda t: t.name)
def test_create_is_empty_and_repeatable(spark, tmp_path, table):
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.create_table(spark, path, table)
    df = scan_table(spark, path, table)
    assert df.schema == table.schema
    assert df.count() == 0


def test_overwrite_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.overwrite_partitions(downloads(spark, row(D1), row(D2)), path, DOWNLOADS)
    sinks.overwrite_partitions(downloads(spark, row(D2, n=5), row(D3)), path, DOWNLOADS)
    expected = [(D1, 1), (D2, 5), (D3, 1)]
    read = scan_table(spark, path, DOWNLOADS)
    assert rows(read, "download_date", "download_count") == expected
    sinks.overwrite_partitions(downloads(spark), path, DOWNLOADS)
    assert rows(scan_table(spark, path, DOWNLOADS), "download_date", "download_count") == expected


def test_replace_partition_clears(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.overwrite_partitions(downloads(spark, row(D1), row(D2)), path, DOWNLOADS)
    for _ in range(2):
        sinks.replace_partition(downloads(spark, row(D1, n=7)), path, DOWNLOADS, D1)
    assert rows(scan_table(spark, path, DOWNLOADS), "download_date", "download_count") == [(D1, 7), (D2, 1)]
    sinks.replace_partition(downloads(spark), path, DOWNLOADS, D1)
    assert rows(scan_table(spark, path, DOWNLOADS), "download_date") == [(D2,)]


def test_clear_and_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_partitions(downloads(spark, row(D1), row(D2)), path, DOWNLOADS)
    sinks.clear_table(spark, path, DOWNLOADS)
    assert scan_table(spark, path, DOWNLOADS).count() == 0


def test_retention_is_strict(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    rollup = spark.createDataFrame(
        [(d, "p", "1", "US", 1, 1, 1, 1, 1, 1) for d in days], CUMULATIVE_DOWNLOADS.schema
    )
    sinks.overwrite_partitions(rollup, path, CUMULATIVE_DOWNLOADS)
    kept = sinks.within_retention(rollup, "reference_date", date(2024, 2, 1), 30)
    assert rows(kept, "reference_date") == [(days[1],), (days[2],)]
    expired = sinks.drop_expired(spark, path, CUMULATIVE_DOWNLOADS, date(2024, 2, 1), 30)
    assert expired == ["2024-01-01"]
    assert scan_table(spark, path, CUMULATIVE_DOWNLOADS).count() == 2


def test_compaction_keeps_rows(spark, tmp_path, rows):
    path = tmp_path / "t"
    data = downloads(spark, *[row(D1, version=str(i)) for i in range(40)], row(D2))
    data.repartition(6, "project_version").write.partitionBy("download_date").parquet(str(path))
    before = rows(scan_table(spark, str(path), DOWNLOADS))
    files = lambda: list((path / f"download_date={D1}").glob("*.parquet"))
    assert len(files()) > 2
    assert sinks.compact_partition(spark, str(path), DOWNLOADS, D1) == 1
    assert len(files()) == 1
    assert rows(scan_table(spark, str(path), DOWNLOADS)) == before
    assert sinks.compact_partition(spark, str(path), DOWNLOADS, D1) == 0
    assert sinks.compact_partition(spark, str(path), DOWNLOADS, D3) == 0


def test_compaction_leaves_large_files(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    folder = tmp_path / "t" / f"download_date={D1}"
    large = downloads(spark, *[row(D1, version=f"{i}-{hash((i, 1)):x}") for i in range(3000)])
    large.coalesce(1).write.partitionBy("download_date").parquet(path)
    (kept,) = folder.glob("*.parquet")
    size, time = kept.stat().st_size, kept.stat().st_mtime_ns
    late = downloads(spark, *[row(D1, version=f"late{i}") for i in range(40)])
    late.repartition(6, "project_version").write.mode("append").partitionBy("download_date").parquet(path)
    before = rows(scan_table(spark, path, DOWNLOADS))
    assert len(list(folder.glob("*.parquet"))) > 4
    assert sinks.compact_partition(spark, path, DOWNLOADS, D1, target_bytes=size) == 1
    assert kept.stat().st_mtime_ns == time and len(list(folder.glob("*.parquet"))) == 2
    assert rows(scan_table(spark, path, DOWNLOADS)) == before
    assert sinks.compact_partition(spark, path, DOWNLOADS, D1, target_bytes=size) == 0


@pytest.mark.parametrize("step", ["delete_tree", "rename", "write_text"])
def test_interrupted_compaction_is_completed(spark, tmp_path, rows, monkeypatch, step):
    path = str(tmp_path / "t")
    data = downloads(spark, *[row(D1, version=str(i)) for i in range(40)])
    data.repartition(6, "project_version").write.partitionBy("download_date").parquet(path)
    before, calls = rows(scan_table(spark, path, DOWNLOADS)), []

    def fail_once(*args):
        calls.append(args)
        # The first deletion is that of what an earlier run may have left.
        if len(calls) == {"delete_tree": 3}.get(step, 1):
            raise OSError("gone")
        return real(*args)

    real = getattr(storage, step)
    with monkeypatch.context() as patch:
        patch.setattr(storage, step, fail_once)
        with pytest.raises(OSError, match="gone"):
            sinks.compact_partition(spark, path, DOWNLOADS, D1)
    sinks.compact_partition(spark, path, DOWNLOADS, D1)
    assert rows(scan_table(spark, path, DOWNLOADS)) == before
    assert len(list((tmp_path / "t" / f"download_date={D1}").iterdir())) <= 4


def test_export_layout(spark, tmp_path):
    data = downloads(
        spark, *[row(D1, project=f"p{i % 7}", system="LDW"[i % 3], country="UD"[i % 2]) for i in range(50)]
    )
    target = sinks.export_clustered(data, str(tmp_path), D1, partitions=4)
    assert target.endswith("2024-01-01")
    assert spark.read.parquet(target).count() == 50
    fixed = clustered(data, 4).withColumn("part", F.spark_partition_id())
    assert fixed.rdd.getNumPartitions() == 4
    assert fixed.groupBy("project").agg(F.countDistinct("part").alias("n")).where("n > 1").count() == 0


def test_hot_project_is_split(spark, tmp_path):
    """With run-time sizing one project's rows spread over several tasks."""
    data = spark.range(200_000).select(
        F.lit(D1).alias("download_date"),
        F.lit("hot").alias("project"),
        F.col("id").cast("string").alias("project_version"),
        F.sha2(F.col("id").cast("string"), 256).alias("python"),
        F.lit("L").alias("system_name"),
        F.lit("US").alias("country_code"),
        F.lit(1).alias("download_count"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        target = sinks.export_clustered(data.repartition(8), str(tmp_path), D1)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "2024-01-01").glob("*.parquet"))) > 2
    assert spark.read.parquet(target).count() == 200_000


def test_conform_needs_all_columns(spark):
    with pytest.raises(ValueError, match="country_code"):
        conform(downloads(spark).drop("country_code"), DOWNLOADS.schema)


def test_partition_scan_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    posts = spark.createDataFrame([("a", "x", 1, D1), ("b", "y", 2, D3)], POSTS.schema)
    sinks.overwrite_partitions(posts, path, POSTS)
    day = scan_table_partition(spark, path, POSTS, "created_date", D3)
    assert [r["id"] for r in day.collect()] == ["b"]
    assert all("created_month=2024-02" in f for f in day.inputFiles()) and day.inputFiles()
    assert scan_table_partition(spark, path, POSTS, "created_date", date(2030, 1, 1)).count() == 0


# --- merges ------------------------------------------------------------------


def posts(spark, *data):
    return spark.createDataFrame(list(data), POSTS.schema)


def test_upsert_moves_inserts_updates(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    upsert(spark, posts(spark, ("a", "x", 1, D1), ("b", "y", 2, D3), ("c", "z", 3, D1)), path, POSTS)
    second = posts(spark, ("b", "Y", 9, D1), ("c", "Z", 8, D2), ("d", "w", 4, D2))
    expected = [("a", "x", 1, D1), ("b", "Y", 9, D1), ("c", "Z", 8, D2), ("d", "w", 4, D2)]
    for _ in range(2):
        upsert(spark, second, path, POSTS)
        assert rows(scan_table(spark, path, POSTS)) == expected
    # The month that lost its only row is gone.
    assert storage.partition_values(spark, path, "created_month") == ["2024-01"]


def test_upsert_duplicates(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    upsert(spark, posts(spark, ("a", "x", 1, D1)), path, POSTS)
    # Unmatched duplicates are both inserted.
    upsert(spark, posts(spark, ("n", "1", 1, D1), ("n", "2", 2, D1)), path, POSTS)
    assert rows(scan_table(spark, path, POSTS), "id", "text") == [("a", "x"), ("n", "1"), ("n", "2")]
    # Two source rows for one target row are an error, and nothing changes.
    twice = posts(spark, ("a", "old", 1, D1), ("a", "new", 2, D2))
    with pytest.raises(CardinalityViolation):
        upsert(spark, twice, path, POSTS)
    upsert(spark, twice, path, POSTS, dedupe_by="score")
    assert ("a", "new") in rows(scan_table(spark, path, POSTS), "id", "text")
    # One source row updates every row that it matches.
    upsert(spark, posts(spark, ("n", "3", 3, D3)), path, POSTS)
    assert rows(scan_table(spark, path, POSTS), "id", "text") == [("a", "new"), ("n", "3"), ("n", "3")]


def test_upsert_null_ids_and_null_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    nothing = (None, None, None, None)
    for _ in range(2):
        upsert(spark, posts(spark, nothing, ("a", "x", 1, D1)), path, POSTS)
    assert rows(scan_table(spark, path, POSTS)) == sorted([("a", "x", 1, D1), nothing, nothing], key=repr)
    # A row can leave the partition without a date, which then has no rows.
    other = str(tmp_path / "u")
    upsert(spark, posts(spark, ("a", "x", 1, None)), other, POSTS)
    upsert(spark, posts(spark, ("a", "x", 1, D1)), other, POSTS)
    assert rows(scan_table(spark, other, POSTS)) == [("a", "x", 1, D1)]


def test_publish_keys(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = downloads(spark, row(D1, python=None, system=None, country=None), row(D1, version=None, n=2), row(D2))
    upsert(spark, first, path, DOWNLOADS, PUBLISH_KEYS)
    second = downloads(spark, row(D1, python="", system="", country="", n=10), row(D1, version=None, n=20))
    upsert(spark, second, path, DOWNLOADS, PUBLISH_KEYS)
    # Blank and NULL are one key; a NULL version matches nothing.
    assert rows(scan_table(spark, path, DOWNLOADS), "download_date", "python", "download_count") == sorted(
        [(D1, "", 10), (D1, "3", 2), (D1, "3", 20), (D2, "3", 1)], key=repr
    )


def test_upsert_leaves_no_scratch(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir")
    before = storage.glob(spark, f"{base}/upsert-*")
    path = str(tmp_path / "t")
    upsert(spark, posts(spark, ("a", "x", 1, D1)), path, POSTS)
    upsert(spark, posts(spark, ("a", "x", 2, D1)), path, POSTS)
    assert storage.glob(spark, f"{base}/upsert-*") == before


def test_anti_join_keeps_null_keys_out_of_the_join(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 10, F.col("id")).alias("k"), "id")
    right = spark.range(5).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = left_anti_on(left, right, ["k"])
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 995
        assert "Union" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_catalog_merge_needs_row_level_operations(spark, tmp_path):
    spark.sql(f"CREATE TABLE IF NOT EXISTS plain_posts (id STRING, text STRING) USING parquet LOCATION '{tmp_path}/m'")
    try:
        source = spark.createDataFrame([("a", "x")], "id string, text string")
        with pytest.raises(Exception, match="MERGE"):
            merge_into_catalog(source, "plain_posts", ["id"])
    finally:
        spark.sql("DROP TABLE plain_posts")


def test_comments_keep_maps(spark, tmp_path):
    path = str(tmp_path / "t")
    data = spark.createDataFrame([("a", {"gid_1": 1}, D1)], "id string, gildings map<string,int>, created_date date")
    for _ in range(2):
        upsert(spark, data.to(COMMENTS.schema), path, COMMENTS)
    assert scan_table(spark, path, COMMENTS).first()["gildings"] == {"gid_1": 1}


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda key, default: None)})
        sparkContext = type("S", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.scratch(Cluster, "x")


def test_widened_keeps_everything_else():
    wide = DOWNLOADS.widened()
    assert wide.schema["download_count"].dataType.simpleString() == "bigint"
    assert replace(wide, schema=DOWNLOADS.schema) == DOWNLOADS


def test_dedupe_orders_nulls_last(spark):
    data = posts(spark, ("a", "x", None, D1), ("a", "y", 1, D1), ("b", "z", None, D1), (None, "n", 1, D1), (None, "m", 2, D1))
    from tidemark.operators.upsert import latest_per_key

    kept = sorted((r["id"] or "", r["text"]) for r in latest_per_key(data, ["id"], "score").collect())
    assert kept == [("", "m"), ("", "n"), ("a", "y"), ("b", "z")]


def test_failed_audit_leaves_production_alone(spark, tmp_path):
    from tidemark.operators.audit import AuditFailure
    from tidemark.plans.downloads import publish_downloads
    from tidemark.schemas import RAW_DOWNLOAD_EVENTS
    from datetime import datetime

    def event(day, country, version="1"):
        return (datetime(2024, 1, day, 12), "p", (version,), ("3", ("L",)), country)

    paths = [str(tmp_path / n) for n in ("staging", "invalid", "production")]
    good = spark.createDataFrame([event(1, "US"), event(1, "US"), event(2, "US")], RAW_DOWNLOAD_EVENTS)
    result = publish_downloads(spark, good, D1, "p", *paths)
    assert (result.row_count, result.total_invalid) == (1, 0)
    bad = spark.createDataFrame([event(2, "usa"), event(2, "US")], RAW_DOWNLOAD_EVENTS)
    with pytest.raises(AuditFailure):
        publish_downloads(spark, bad, D2, "p", *paths)
    production = scan_table(spark, paths[2], DOWNLOADS)
    assert [(r["download_date"], r["download_count"]) for r in production.collect()] == [(D1, 2)]
    # What failed stays staged for inspection.
    assert scan_table(spark, paths[0], DOWNLOADS).count() == 2


def test_backfill_is_the_union_of_days(spark, tmp_path, rows):
    from datetime import datetime

    from tidemark.plans.downloads import backfill_downloads
    from tidemark.schemas import RAW_DOWNLOAD_EVENTS

    events = spark.createDataFrame(
        [(datetime(2024, 1, 1 + i % 4, i % 24), "pq"[i % 2], ("1",), ("3", (None,)), None) for i in range(60)],
        RAW_DOWNLOAD_EVENTS,
    )
    whole, daily = str(tmp_path / "whole"), str(tmp_path / "daily")
    backfill_downloads(events, "2024-01-01", "2024-01-04", "p,q", whole)
    for day in (1, 2, 3):
        backfill_downloads(events, date(2024, 1, day), date(2024, 1, day + 1), ["p", "q"], daily)
    got = rows(scan_table(spark, whole, DOWNLOADS))
    assert got == rows(scan_table(spark, daily, DOWNLOADS)) and len(got) == 3


def test_a_batch_that_changes_nothing_rewrites_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = COMMENTS.schema

    def batch(*rows):
        made = spark.createDataFrame([(i, d, s) for i, d, s in rows], "id string, created_date date, score long")
        present = {"id", "created_date", "score"}
        return made.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    first = [("a", date(2025, 1, 3), 1), ("b", date(2025, 1, 4), 2), ("c", date(2025, 2, 5), 3)]
    sinks.create_table(spark, path, COMMENTS)
    upsert(spark, batch(*first), path, COMMENTS)
    files = lambda: storage.files(spark, f"{path}/*/part-*")
    before = files()
    upsert(spark, batch(*first), path, COMMENTS)
    assert files() == before
    # One row of February differs: January's files stay.
    upsert(spark, batch(first[0], ("c", date(2025, 2, 5), 9)), path, COMMENTS)
    kept = {f for f in before if f in files()}
    assert len(kept) == len(before) - 1 and len(before) == 2
    got = {(r["id"], r["score"]) for r in scan_table(spark, path, COMMENTS).collect()}
    assert got == {("a", 1), ("b", 2), ("c", 9)}
