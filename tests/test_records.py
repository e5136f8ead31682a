from __future__ import annotations

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import epoch_to_date
from tidemark.functions.decode import typed_from_strings
from tidemark.functions.nulls import falsy_to_null
from tidemark.plans.content import ingest_records, load_content, mentions_job
from tidemark.schemas import (
    COMMENT_RECORD,
    COMMENTS,
    FETCH_FIELDS,
    MENTIONS,
    REQUIRED_COMMENT,
    REQUIRED_SUBMISSION,
    SUBMISSION_RECORD,
    SUBMISSIONS,
)
from tidemark.sources.dimensions import Project
from tidemark.sources.json_lines import records_folder, scan_comments, scan_json, scan_submissions
from tidemark.sources.tables import scan_table
from tidemark.sources.validation import check_records, invalid_records, valid_records
from tidemark.streaming.ingest import ingest_new_files
from pyspark.sql import types as T

NOW = datetime(2025, 1, 6, 1, 2, 3, tzinfo=UTC)
_SAMPLE = {"boolean": True, "int": 3, "double": 1736035199.5, "string": "x"}


def record(schema, **changes):
    """A complete record, with some fields changed; ``...`` drops one."""
    made = {
        f.name: _SAMPLE.get(f.dataType.simpleString(), {} if isinstance(f.dataType, T.MapType) else [])
        for f in schema
        if f.name not in FETCH_FIELDS
    }
    made.update({k: None for k in ("media", "media_embed", "secure_media") if k in made}, edited=False)
    made.update(changes)
    return json.dumps({k: v for k, v in made.items() if v is not ...})


def test_field_counts():
    assert len(SUBMISSION_RECORD) == 62 and len(SUBMISSIONS.schema) == 65
    assert len(COMMENT_RECORD) == 37 and len(COMMENTS.schema) == 38
    assert len(REQUIRED_SUBMISSION) == 27 and len(REQUIRED_COMMENT) == 15
    assert set(REQUIRED_SUBMISSION) <= set(SUBMISSION_RECORD.names)
    assert set(REQUIRED_COMMENT) <= set(COMMENT_RECORD.names)


@pytest.mark.parametrize(
    ("changes", "errors"),
    [
        ({}, []),
        ({"author_fullname": ...}, []),
        ({"category": None, "media": {"a": 1.5}, "gildings": {"gid": 1}}, []),
        ({"created_utc": 1736035200}, []),
        ({"category": ...}, ["category: missing"]),
        ({"title": None}, ["title: null"]),
        ({"ups": "1"}, ["ups: not a integer"]),
        ({"ups": 1.5, "id": 7}, ["id: not a string", "ups: not a integer"]),
        ({"archived": "true"}, ["archived: not a boolean"]),
        ({"media": "text"}, ["media: not a object"]),
        ({"treatment_tags": {}}, ["treatment_tags: not a list"]),
        ({"edited": "no"}, ["edited: not a boolean or number"]),
        ({"edited": 1736035200}, []),
        ({"unknown": 1}, []),
    ],
)
def test_submission_rules(spark, changes, errors):
    lines = spark.createDataFrame([(record(SUBMISSION_RECORD, **changes),)], "value string")
    assert check_records(lines, "submissions").first()["errors"] == errors


@pytest.mark.parametrize("line", ["{bad json", "[1]", "null", "", "7"])
def test_not_an_object(spark, line):
    checked = check_records(spark.createDataFrame([(line,)], "value string"), "comments")
    assert checked.first()["errors"] == ["not a JSON object"]
    assert invalid_records(checked).count() == 1


def test_edited(spark):
    given = [False, 0, 0.0, True, 1736035200, 1736035200.5]
    lines = spark.createDataFrame([(record(COMMENT_RECORD, edited=e),) for e in given], "value string").coalesce(1)
    valid = valid_records(check_records(lines, "comments"), "comments", NOW)
    assert [r["edited"] for r in valid.collect()] == [None, None, None, "true", "1736035200.0", "1736035200.5"]
    row = valid.first()
    assert (row["_fetched_date"], row["_fetched_iso_utc"]) == ("2025-01-06", "2025-01-06T01:02:03+00:00")
    assert set(valid.columns) == set(COMMENT_RECORD.names)


def test_objects_keep_their_numbers(spark):
    lines = spark.createDataFrame([(record(SUBMISSION_RECORD, media={"at": 1736035200.5}),)], "value string")
    valid = valid_records(check_records(lines, "submissions"), "submissions", NOW)
    assert valid.first()["media"] == '{"at":1736035200.5}'


def test_ingest_writes_both_outcomes(spark, tmp_path):
    root = str(tmp_path / "api")
    good, bad = record(COMMENT_RECORD, id="a"), record(COMMENT_RECORD, id="b", body=None)
    lines = spark.createDataFrame([("DataScience", good), ("DataScience", bad), ("analytics", good)], "subreddit string, value string")
    for _ in range(2):
        ingest_records(lines, root, "comments", NOW)
    valid = records_folder(root, "comments", "valid", "2025-01-06")
    assert scan_json(spark, [valid], COMMENT_RECORD).count() == 2
    invalid = spark.read.schema("invalid_record struct<id:string>, error string").json(
        records_folder(root, "comments", "invalid", "2025-01-06")
    )
    assert [tuple(r) for r in invalid.select("invalid_record.id", "error").collect()] == [("b", "body: null")]
    assert (tmp_path / "api/comments/fetched_date=2025-01-06/status=invalid/subreddit=datascience").exists()
    assert not (tmp_path / "api/comments/fetched_date=2025-01-06/status=invalid/subreddit=analytics").exists()


def test_scan_is_permissive(spark, tmp_path):
    lines = [
        '{"id": "1", "edited": 1700000000.0, "media": {"a": [1]}, "gildings": {"g": 2}, "ups": 3}',
        '{"id": "2", "ups": "x"}',
        "{bad json",
    ]
    (tmp_path / "one_submissions.json").write_text("\n".join(lines))
    (tmp_path / "one_comments.json").write_text('{"id": "c"}')
    rows = sorted(scan_submissions(spark, str(tmp_path)).collect(), key=lambda r: r["id"] or "")
    assert [(r["id"], r["ups"]) for r in rows] == [(None, None), ("1", 3), ("2", None)]
    assert (rows[1]["edited"], rows[1]["media"], rows[1]["gildings"]) == ("1700000000.0", '{"a": [1]}', {"g": 2})
    assert scan_comments(spark, str(tmp_path)).count() == 1


def test_scan_of_an_empty_prefix(spark, tmp_path):
    df = scan_submissions(spark, str(tmp_path / "none"))
    assert df.schema == SUBMISSION_RECORD and df.count() == 0


def test_epoch_in_any_time_zone(spark):
    df = spark.createDataFrame([(1736035199.5,), (1736035200.0,), (-0.5,)], "e double")
    expected = [date(2025, 1, 4), date(2025, 1, 5), date(1969, 12, 31)]
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert [r[0] for r in df.select(epoch_to_date(F.col("e"))).collect()] == expected
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_falsy(spark):
    df = spark.createDataFrame([("false",), ("0",), ("0.0",), ("true",), ("1.5",), (None,)], "e string").coalesce(1)
    assert [r[0] for r in df.select(falsy_to_null(F.col("e"))).collect()] == [None, None, None, "true", "1.5", None]


def test_decode(spark):
    schema = T.StructType([
        T.StructField("d", T.DateType()), T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType()),
        T.StructField("f", T.DoubleType()), T.StructField("l", T.ArrayType(T.StringType())),
    ])
    data = [("2024-01-02", "7", "x", "1.5", "[a, b]"), (None,) * 5, (None, None, None, None, "[]")]
    df = spark.createDataFrame(data, "d string, n string, s string, f string, l string").coalesce(1)
    assert [tuple(r) for r in typed_from_strings(df, schema).collect()] == [
        (date(2024, 1, 2), 7, "x", 1.5, ["a", "b"]), (None,) * 5, (None, None, None, None, [""])
    ]
    with pytest.raises(ValueError):
        typed_from_strings(df, T.StructType([T.StructField("n", T.LongType())]))
    bad = spark.createDataFrame([("x",)], "n string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed_from_strings(bad, T.StructType([T.StructField("n", T.IntegerType())])).collect()


def test_load_then_mentions(spark, tmp_path):
    source = tmp_path / "valid"
    source.mkdir()
    (source / "a_submissions.json").write_text(record(SUBMISSION_RECORD, id="s1", selftext="I like Duck DB and duckdb"))
    (source / "a_comments.json").write_text(
        "\n".join(record(COMMENT_RECORD, id=f"c{i}", body=body) for i, body in enumerate(["spark is slow", "none"]))
    )
    paths = [str(tmp_path / n) for n in ("submissions", "comments", "mentions")]
    for _ in range(2):
        load_content(spark, str(source), paths[0], paths[1])
    assert scan_table(spark, paths[0], SUBMISSIONS).first()["created_date"] == date(2025, 1, 4)
    projects = [Project("Spark", ("Spark",)), Project("DuckDB", ("Duck DB",))]
    for _ in range(2):
        mentions_job(spark, "2025-01-04", *paths, projects=projects)
    found = {r["id"]: r for r in scan_table(spark, paths[2], MENTIONS).collect()}
    assert set(found) == {"s1", "c0", "c1"}
    assert [tuple(m) for m in found["s1"]["projects_mentions"]] == [("DuckDB", 2)]
    assert found["c0"]["projects_mentions_polarity"][0]["polarity"] == -1.0
    assert found["c1"]["projects_mentions"] is None and found["c1"]["projects_mentions_polarity"] is None


def test_stream_reads_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    path, state, archive = (str(tmp_path / n) for n in ("t", "state", "archive"))

    def run():
        query = ingest_new_files(
            spark, str(source), "comments", path, state, archive_dir=archive, max_files=1, files="*_comments.json"
        )
        query.awaitTermination()
        return sorted((r["id"], r["ups"]) for r in scan_table(spark, path, COMMENTS).collect())

    assert run() == []
    (source / "a_comments.json").write_text(record(COMMENT_RECORD, id="1", ups=1))
    (source / "a_submissions.json").write_text("{}")
    assert run() == [("1", 1)]
    (source / "b_comments.json").write_text("\n".join(record(COMMENT_RECORD, id=i, ups=5) for i in "12"))
    assert run() == [("1", 5), ("2", 5)]
    assert run() == [("1", 5), ("2", 5)]
