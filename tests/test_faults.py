"""Inputs that once gave wrong rows without a word."""

from __future__ import annotations

import json
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_records import NOW, record
from tidemark.functions.bands import Band, gapless
from tidemark.operators.intervals import join_bands
from tidemark.operators import sinks
from tidemark.operators.downloads import agg_daily_downloads
from tidemark.operators.layout import clustered
from tidemark.operators.upsert import PUBLISH_KEYS, catalog_merge, latest_per_key
from tidemark.plans.content import ingest_records, load_content
from tidemark.plans.downloads import aggregate_downloads, audit_downloads
from tidemark.schemas import (
    COMMENT_RECORD,
    COMMENTS,
    CUMULATIVE_DOWNLOADS,
    DOWNLOADS,
    SUBMISSION_RECORD,
    SUBMISSIONS,
    quarantine_of,
)
from tidemark.sources.dimensions import BANDS, band_rows
from tidemark.sources.json_lines import records_folder, scan_comments, scan_json, select_files
from tidemark.sources.pages import read_pages
from tidemark.sources.tables import scan_table
from tidemark.sources.validation import check_records
from tidemark.streaming.ingest import ingest_new_files

D = date(2024, 1, 10)


def lines(spark, model, *changes):
    rows = [("DataScience", record(model, **c)) for c in changes]
    return spark.createDataFrame(rows, "subreddit string, value string")


def test_validated_records_load(spark, tmp_path):
    root = str(tmp_path / "records")
    media = {"at": 1736035200.5, "in": {"a": [1, None]}}
    ingest_records(lines(spark, SUBMISSION_RECORD, {"id": "s", "media": media, "edited": 1736035200}), root, "submissions", NOW)
    ingest_records(lines(spark, COMMENT_RECORD, {"id": "c", "edited": False}, {"id": "d", "ups": None}), root, "comments", NOW)
    for kind in ("submissions", "comments"):
        kept = spark.read.text(records_folder(root, kind, "valid", "2025-01-06"), recursiveFileLookup=True)
        assert [r.errors for r in check_records(kept, kind).collect()] == [[]]
    paths = [str(tmp_path / n) for n in ("submissions", "comments")]
    load_content(spark, root, *paths)
    (row,) = scan_table(spark, paths[0], SUBMISSIONS).collect()
    assert (row.id, row.edited, json.loads(row.media)) == ("s", "1736035200.0", media)
    assert row._fetched_iso_utc == NOW.isoformat()
    (row,) = scan_table(spark, paths[1], COMMENTS).collect()
    assert (row.id, row.edited) == ("c", None)


def test_a_folder_without_the_kind_is_an_error(spark, tmp_path):
    (tmp_path / "one_comments.json").write_text(record(COMMENT_RECORD))
    assert scan_comments(spark, str(tmp_path)).count() == 1
    with pytest.raises(FileNotFoundError):
        select_files(spark, str(tmp_path), "submissions")


def test_pending_days_overlap(spark, tmp_path):
    root, path, state = (str(tmp_path / n) for n in ("records", "t", "state"))

    def run(*days):
        for day, ups in days:
            ingest_records(lines(spark, COMMENT_RECORD, {"id": "a", "ups": ups}, {"id": f"own{day}"}), root, "comments", NOW + timedelta(days=day))
        ingest_new_files(spark, root, "comments", path, state).awaitTermination()
        return sorted((r.id, r.ups) for r in scan_table(spark, path, COMMENTS).where("id = 'a'").collect())

    assert run((0, 5), (1, 7)) == [("a", 7)]
    assert run((3, 9), (2, 8)) == [("a", 9)]
    assert run() == [("a", 9)]


def test_ties_are_decided(spark):
    rows = spark.createDataFrame([("a", "t", i) for i in range(20)], "id string, at string, n int")
    first = {r.n for r in latest_per_key(rows.repartition(3), ["id"], "at").collect()}
    assert first == {r.n for r in latest_per_key(rows.orderBy(F.desc("n")), ["id"], "at").collect()}


@pytest.mark.parametrize(
    "changes, error",
    [
        ({"ups": 3_000_000_000}, "ups: out of range"),
        ({"gildings": {"gid_1": "x"}}, "gildings: a value is not an integer in range"),
        ({"gildings": {"gid_1": 1 << 40}}, "gildings: a value is not an integer in range"),
        ({"treatment_tags": [1, {"a": 2}]}, "treatment_tags: an element is not a string"),
        ({"treatment_tags": ["a", None]}, "treatment_tags: an element is not a string"),
        ({"gildings": {}, "treatment_tags": [], "ups": -5}, None),
        ({"gildings": {"gid_1": 1}, "treatment_tags": ["a", "b"]}, None),
    ],
)
def test_values_that_would_be_lost(spark, changes, error):
    found = check_records(lines(spark, SUBMISSION_RECORD, changes), "submissions").first()["errors"]
    assert found == ([error] if error else [])


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "one_comments.json").write_text("{bad json\n" + record(COMMENT_RECORD, id="c") + '\n{"id": "d", "ups": "x"}')
    path = str(tmp_path)
    ids = lambda mode: sorted(str(r.id) for r in scan_comments(spark, path, mode).collect())
    assert ids("null") == ["None", "c", "d"]
    assert ids("drop") == ["c", "d"]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        ids("fail")
    with pytest.raises(ValueError):
        ids("other")
    loaded = [str(tmp_path / n) for n in ("s", "t")]
    (tmp_path / "one_submissions.json").write_text(record(SUBMISSION_RECORD))
    for _ in range(3):
        load_content(spark, path, *loaded, on_malformed="drop")
    assert scan_table(spark, loaded[1], COMMENTS).count() == 2


def test_pages(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    (tmp_path / "1.csv").write_text('a,b\n1,"x\ny"\n2,\n')
    assert sorted(map(tuple, read_pages(spark, str(tmp_path), schema).collect())) == [("1", "x\ny"), ("2", None)]
    for bad in ("b,a\n1,x\n", "a,b\n1\n", "a,b\n1,2,3\n"):
        folder = tmp_path / str(len(bad)) / bad[:1]
        folder.mkdir(parents=True)
        (folder / "1.csv").write_text(bad)
        with pytest.raises(Exception):
            read_pages(spark, str(folder), schema).collect()


def downloads(spark, *rows):
    full = [(d, p, v, py, "L", c, n) for d, p, v, py, c, n in rows]
    return spark.createDataFrame(full, DOWNLOADS.schema)


def test_other_dates_are_not_dropped(spark, tmp_path):
    rows = downloads(spark, (D, "a", "1", "3", "US", 1), (date(2024, 1, 11), "a", "1", "3", "US", 2))
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="a row of 2024-01-11 among those of 2024-01-10"):
        sinks.replace_partition(rows, path, DOWNLOADS, D)
    with pytest.raises(ValueError):
        sinks.replace_partition(rows, path, SUBMISSIONS, D)
    with pytest.raises(ValueError):
        sinks.compact_partition(spark, path, SUBMISSIONS, D)


def test_a_clean_retry_empties_the_quarantine(spark, tmp_path):
    path, table = str(tmp_path / "q"), quarantine_of(DOWNLOADS)
    audit_downloads(downloads(spark, (D, "a", "1", "3", "US", 1)), path, D)
    assert scan_table(spark, path, table).count() == 0
    audit_downloads(downloads(spark, (D, "a", "1", "3", "US", -1)), path, D, tolerance=0)
    assert scan_table(spark, path, table).count() > 0
    audit_downloads(downloads(spark, (D, "a", "1", "3", "US", 1)), path, D)
    assert scan_table(spark, path, table).count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_days_in_any_time_zone(spark, tmp_path, kind):
    at = [datetime(2024, 1, 1, 23, 59, 59), datetime(2024, 1, 2, 0, 0), datetime(2024, 1, 2, 2, 0), datetime(2024, 1, 3, 0, 0)]
    micros = [int(t.replace(tzinfo=UTC).timestamp() * 1e6) for t in at]
    found = []
    for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        rows = spark.createDataFrame([(m,) for m in micros], "m long").select(
            F.timestamp_micros("m").cast(kind).alias("timestamp"),
            F.lit("p").alias("project"),
            F.expr("struct('1' AS version)").alias("file"),
            F.expr("struct('3' AS python, struct('L' AS name) AS system)").alias("details"),
            F.lit("US").alias("country_code"),
        )
        path = str(tmp_path / zone.replace("/", "-"))
        rows.write.parquet(path)
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            daily = agg_daily_downloads(spark.read.parquet(path), "2024-01-02", "2024-01-03", "p")
            plan = daily._jdf.queryExecution().executedPlan().toString()
            pushed = plan.split("PushedFilters: [")[1].split("]")[0]
            assert "GreaterThanOrEqual(timestamp" in pushed
            found.append([(str(r.download_date), r.download_count) for r in daily.collect()])
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [[("2024-01-02", 2)]] * 3


BIG = [Band("all", 0, -1e9, 1e9), Band("point", 1, 0.5, 0.5), Band("far", 2, 1e9, float("inf"))]


@pytest.mark.parametrize("bands", [gapless(BANDS), BIG, [Band(str(i), i, i / 7, i / 3) for i in range(200)], []])
def test_bands_of_any_size(spark, bands):
    values = [-1e10, -1.0, -0.2, 0.0, 0.5, 0.7, 3.0, 1e9, 2e9, float("-inf"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "polarity double")
    joined = join_bands(df, "polarity", band_rows(spark, bands))
    want = []
    for v in values:
        names = [b.category for b in bands if v is not None and b.lower <= v <= b.upper]
        want += [(v, n) for n in names or [None]]
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(want, key=repr)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_catalog_merge_takes_the_keys(spark):
    target = downloads(spark, (D, "a", "1", None, "US", 1), (D, "a", None, "3", "US", 2), (D, "b", "1", "3", None, 3))
    source = downloads(spark, (D, "a", "1", "", "US", 10), (D, "a", None, "3", "US", 20), (D, "b", "1", "3", "", 30))
    renamed, on = catalog_merge(source, PUBLISH_KEYS)
    matched = target.join(renamed, on).select("download_count", "_new_download_count").collect()
    assert sorted(map(tuple, matched)) == [(1, 10), (3, 30)]
    # Equal, but for the NULL version, which matches nothing.
    assert source.count() == 3


def test_files_are_sorted(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(2000).select(
        F.col("id").cast("string").alias("id"),
        F.date_add(F.lit(date(2025, 1, 1)), (F.col("id") * 7 % 59).cast("int")).alias("created_date"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in COMMENTS.schema if f.name not in ("id", "created_date")],
    )
    sinks.overwrite_partitions(rows.repartition(5), path, COMMENTS)
    files = spark.read.parquet(path).select("created_date", "id", F.input_file_name().alias("file"), F.col("_metadata.row_index").alias("at"))
    by_file = {}
    for r in files.orderBy("file", "at").collect():
        by_file.setdefault(r.file, []).append((r.created_date, r.id))
    assert len(by_file) >= 2 and all(v == sorted(v) for v in by_file.values())


def test_dashboard_order_inside_partitions(spark):
    rows = spark.createDataFrame([(D, f"p{i % 3}", "1", "3", f"s{i * 7 % 5}", f"c{i * 3 % 4}", i) for i in range(60)], DOWNLOADS.schema)
    placed = clustered(rows, 4).withColumn("part", F.spark_partition_id()).collect()
    by_part = {}
    for r in placed:
        by_part.setdefault(r.part, []).append((r.system_name, r.country_code))
    assert all(v == sorted(v) for v in by_part.values())
