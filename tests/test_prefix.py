"""Incremental rollups against the full form, while days come, go and change."""

from __future__ import annotations

import os
import random
import shutil
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.operators import ledger, prefix, rollups, sinks
from tidemark.operators.windows import pypi_cumulative
from tidemark.plans.downloads import aggregate_downloads, extend_prefix
from tidemark.schemas import CUMULATIVE_DOWNLOADS, DOWNLOADS
from tidemark.sources.dimensions import BANDS
from tidemark.sources.tables import scan_table

START = date(2024, 1, 1)


def day_rows(spark, day, seed, keys=4):
    draw = random.Random(f"{day}{seed}")
    pick = lambda *values: draw.choice(values)
    rows = [(day, pick("a", "b"), pick("1", "2", None), "3", "Linux", pick("US", None), draw.randint(1, 9)) for _ in range(keys)]
    columns = "download_date date, project string, project_version string, python string, system_name string, country_code string, download_count int"
    return spark.createDataFrame(rows, columns)


def put(spark, path, day, seed=0):
    sinks.overwrite_partitions(day_rows(spark, day, seed), path, DOWNLOADS)


def folder(path, day):
    return storage.partition_dir(path, "download_date", day)


@pytest.fixture
def run(spark, tmp_path):
    """Rolls up a day in one way and checks it against the full form."""
    source, made = str(tmp_path / "downloads"), str(tmp_path / "cumulative")
    options = {"incremental": {"incremental": True}, "prefix": {"prefix_path": str(tmp_path / "prefix")}}

    def roll(day, way):
        aggregate_downloads(spark, source, made, day, **options[way])
        got = scan_table(spark, made, CUMULATIVE_DOWNLOADS).where(F.col("reference_date") == F.lit(day))
        rows = scan_table(spark, source, DOWNLOADS)
        later = F.coalesce(F.col("download_date") > F.lit(day), F.lit(False))
        full = pypi_cumulative(rows.where(~later) if way == "prefix" else rows, day)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)

    roll.source, roll.prefix = source, options["prefix"]["prefix_path"]
    return roll


@pytest.mark.parametrize("way", ["incremental", "prefix"])
def test_days_come_go_and_change(spark, run, tmp_path, way):
    days = [START + timedelta(days=i) for i in (0, 8, 9, 10, 11, 12, 13)]
    for day in days[:2]:
        put(spark, run.source, day)
    run(days[1], way)
    put(spark, run.source, days[2])
    run(days[2], way)
    # An older day is removed, published again, and put back with its old time.
    kept = str(tmp_path / "kept")
    shutil.copytree(folder(run.source, days[0]), kept)
    shutil.rmtree(folder(run.source, days[0]))
    put(spark, run.source, days[3])
    run(days[3], way)
    put(spark, run.source, days[0], seed=1)
    put(spark, run.source, days[4])
    run(days[4], way)
    shutil.rmtree(folder(run.source, days[0]))
    shutil.copytree(kept, folder(run.source, days[0]))
    assert os.stat(folder(run.source, days[0])).st_mtime < os.stat(folder(run.source, days[4])).st_mtime
    put(spark, run.source, days[5])
    run(days[5], way)
    # The same day again, with other rows; and rows without a date.
    put(spark, run.source, days[5], seed=2)
    run(days[5], way)
    put(spark, run.source, None)
    put(spark, run.source, days[6])
    run(days[6], way)


def test_later_days_and_a_second_run(spark, run):
    """A day that an earlier rollup has seen is not counted twice."""
    for i in range(3):
        put(spark, run.source, START + timedelta(days=i))
    for i in (0, 1, 2, 2, 1):
        run(START + timedelta(days=i), "incremental")
        run(START + timedelta(days=i), "prefix")


def test_a_compacted_day_is_no_change(spark, run):
    put(spark, run.source, START)
    before = ledger.take(spark, run.source, DOWNLOADS)
    rows = scan_table(spark, run.source, DOWNLOADS).collect()
    again = spark.createDataFrame(rows, DOWNLOADS.schema).repartition(3)
    again.drop("download_date").write.mode("overwrite").parquet(folder(run.source, START))
    now = ledger.take(spark, run.source, DOWNLOADS, before)
    assert before[str(START)].files != now[str(START)].files
    assert ledger.changed(before, now) == set()
    # Without the rows known, other files count as a change.
    bare = {value: ledger.Entry(entry.files) for value, entry in before.items()}
    assert ledger.changed(bare, now) == {str(START)}


def test_ledger_round_trip(spark, tmp_path, run):
    put(spark, run.source, START)
    put(spark, run.source, None)
    now = ledger.take(spark, run.source, DOWNLOADS)
    ledger.write(spark, now, str(tmp_path / "l"))
    assert ledger.read(spark, str(tmp_path / "l")) == now and set(now) == {str(START), None}
    assert ledger.read(spark, str(tmp_path / "none")) is None


def test_only_new_days_are_built(spark, run):
    """A new day adds a partition and leaves the others' files alone."""
    for i in range(3):
        put(spark, run.source, START + timedelta(days=i))
    table = extend_prefix(spark, run.source, run.prefix, START + timedelta(days=2), kept_days=5)
    before = storage.file_signatures(spark, run.prefix, prefix.DAY)
    assert len(before) == 3
    put(spark, run.source, START + timedelta(days=7))
    extend_prefix(spark, run.source, run.prefix, START + timedelta(days=7), kept_days=5)
    after = storage.file_signatures(spark, run.prefix, prefix.DAY)
    # A day for each of the last five and the reference; the first is out of reach.
    assert sorted(after) == [str(START + timedelta(days=i)) for i in range(2, 8)]
    assert after[str(START + timedelta(days=2))] == before[str(START + timedelta(days=2))]
    assert table.partition == prefix.DAY


def test_mentions_from_prefix(spark):
    draw = random.Random(6)
    names = [b.category for b in BANDS]
    rows = [
        (START + timedelta(days=draw.randint(0, 40)), draw.choice(["a", "b", None]), draw.choice([*names, None]), draw.randint(1, 9), draw.choice([None, draw.uniform(-1, 1)]))
        for _ in range(300)
    ]
    daily = spark.createDataFrame(rows, "created_date date, project string, polarity_category string, mentions_count int, avg_polarity double")
    projects = spark.createDataFrame([("a",), ("b",), ("c",)], "project_name string")
    day = START + timedelta(days=35)
    sums = prefix.mention_sums(daily)
    made = prefix.prefix_rows(sums, "created_date", prefix.MENTION_KEYS, prefix.MENTION_SUMS, START, day)
    for weighted in (False, True):
        got = prefix.mentions_from_prefix(made, projects, BANDS, day, weighted_avg=weighted).collect()
        full = rollups.reddit_cumulative(daily, projects, BANDS, day, weighted_avg=weighted, bounded_all_time=True)
        want = {(r.project, r.polarity_category): r for r in full.collect()}
        assert len(got) == len(want) and list(got[0].asDict()) == full.columns
        for row in got:
            expected = want[row.project, row.polarity_category].asDict()
            assert all(value == expected[name] or abs(value - expected[name]) < 1e-9 for name, value in row.asDict().items())


def test_no_rows(spark):
    daily = day_rows(spark, START, 0).limit(0)
    made = prefix.prefix_rows(daily, "download_date", ("project",), ("download_count",), START, START)
    assert made.collect() == [] and made.columns == [prefix.DAY, "project", "download_count"]
