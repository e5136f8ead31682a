"""Mixing: targets by plain water filling, and what the mix takes."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EDGES
from tidemark.llm import mixing


def plain_targets(sizes, weights=mixing.WEIGHTS):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        goal = {s: 3 * sizes[s] if s in full else rest * weight[s] / open_weight for s in order}
        over = {s for s in order if s not in full and goal[s] > 3 * sizes[s]}
        if not over:
            return goal
        full |= over


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 1000, "c": 5, None: 3}, {"a": 100}, {"a": 0, "b": 7}, {"a": 1, "b": 2, "c": 300, "d": 1, "e": 90}, {None: 0}],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_takes_the_targets(docs):
    rows = mixing.mix(docs, keep=("doc_id",)).collect()
    assert len(rows) == docs.count()
    sizes, taken, goal = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        goal[r.source] = r.target
        assert r.taken <= 3 * r.size
        assert r.taken == sum(p["words"] * p["times"] for p in r.pieces or ())
        assert r.source_size == sum(x.size for x in rows if x.source == r.source)
    assert goal == pytest.approx(plain_targets(dict(sizes)))
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 3 * mixing.BLOCK
    again = mixing.mix(docs.repartition(7), keep=("doc_id",)).collect()
    key = lambda rs: Counter((r.doc_id, r.size, r.taken) for r in rs)
    assert key(again) == key(rows)


def test_shards_draw_by_chance(docs, spark):
    goals = spark.createDataFrame([("a", 100_000, 60_000.0), ("b", 100_000, 20_000.0)], "source string, source_size long, target double")
    rows = mixing.draws(goals, block_words=4, shard=500).collect()
    by = defaultdict(dict)
    for r in rows:
        by[r.shard][r.source] = r.drawn
    assert Counter({s: sum(v.get(s, 0) for v in by.values()) for s in "ab"}) == {"a": 15_000, "b": 5_000}
    counts = [v["a"] for k, v in by.items() if k >= 0 and sum(v.values()) == 500]
    assert len(set(counts)) > 10 and all(300 < c < 450 for c in counts)


def test_documents_of_the_mix(docs, texts):
    plan = {r.doc_id: r for r in mixing.mix(docs, keep=("doc_id",)).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    got = defaultdict(list)
    for r in out.collect():
        assert r.n_chars == len(r.text)
        got[r.doc_id].append(r.text)
    for d, r in plan.items():
        assert sum(len(words(t)) for t in got[d]) == r.taken
        own = words(texts[d])
        want = Counter(w for p in r.pieces or () for w in own[p["from"] : p["from"] + p["words"]] * p["times"])
        assert Counter(w for t in got[d] for w in words(t)) == want


def test_edge_rows(edges, nothing):
    rows = mixing.mix(edges, keep=("doc_id", "key")).collect() if "key" not in edges.columns else mixing.mix(edges, keep=("doc_id",)).collect()
    assert len(rows) == len(EDGES)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert Counter(r.doc_id for r in rows)[4] == 3
    out = mixing.mixed_documents(edges).collect()
    assert {r.doc for r in out} == {"own doc"}
    assert not {r.doc_id for r in out} & {1, 2, 3}
    total = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in out)
    assert total == sum(r.taken for r in rows)
    assert mixing.mix(nothing).collect() == [] == mixing.mixed_documents(nothing).collect()


def test_small_sources_meet_their_targets(spark):
    goals = [("a", 5, 15.0), ("b", 40, 120.0), ("c", 3200, 1600.0)]
    rows = mixing.draws(spark.createDataFrame(goals, "source string, source_size long, target double")).collect()
    slots = Counter()
    for r in rows:
        slots[r.source] += r.drawn
    assert slots == {"a": 3, "b": 6, "c": 50}


def test_permutations_are_bijections(spark):
    sizes = [*range(1, 70), 99, 100, 101, 255, 256, 257, 1000, 4097, 99_991]
    rows = spark.createDataFrame([(n,) for n in sizes], "n long").selectExpr("n", "explode(sequence(0L, n - 1)) AS i")
    placed = rows.select("n", "i", *[mixing.permuted(F.col("i"), F.col("n"), F.lit(k)).alias(f"p{k}") for k in (1, 2)])
    out = placed.groupBy("n").agg(
        *[f(f"p{k}").alias(f"{name}{k}") for k in (1, 2) for name, f in (("distinct", F.count_distinct), ("low", F.min), ("high", F.max))],
        F.sum((F.col("p1") == F.col("p2")).cast("int")).alias("same"),
        F.sum((F.col("p1") == F.col("i")).cast("int")).alias("fixed"),
    )
    for r in out.collect():
        assert (r.distinct1, r.low1, r.high1) == (r.distinct2, r.low2, r.high2) == (r.n, 0, r.n - 1)
        if r.n > 500:
            assert r.same < r.n / 50 and r.fixed < r.n / 50
