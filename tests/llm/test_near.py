"""Near-duplicates against all pairs."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import EDGES, PROSE
from tidemark.llm import near
from tidemark.llm.common import components


def shingles(text):
    words = (text or "").split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def test_groups_equal_all_pairs(docs, texts):
    own = {d: shingles(t) for d, t in texts.items()}
    holds = defaultdict(set)
    for d, s in own.items():
        for x in s:
            holds[x].add(d)
    # Rare shingles all weigh nearly the same; the plain version counts exactly.
    n = sum(bool(s) for s in own.values())
    weight = lambda d, x: own[d][x] * math.log(1 + n / len(holds[x]))
    total = {d: sum(weight(d, x) for x in s) for d, s in own.items()}
    shared = defaultdict(float)
    for x, ds in holds.items():
        ds = sorted(ds)
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                shared[a, b] += min(weight(a, x), weight(b, x))
    lead = {r.doc_id: r.lead_doc_id for r in near.near_groups(docs).collect()}
    assert set(lead) == set(texts)
    linked = set()
    for (a, b), s in shared.items():
        j = s / (total[a] + total[b] - s)
        if j >= 0.82:
            assert lead[a] == lead[b], (a, b, j)
            linked.add((a, b))
    assert len(linked) > 5
    for d, head in lead.items():
        if d != head:
            assert any(d in pair for pair in linked) or any(0.78 <= s / (total[a] + total[b] - s) for (a, b), s in shared.items() if d in (a, b))


def test_samples_agree_as_often_as_similarity():
    found = near.Shingled(np.repeat([0, 1], 400), np.concatenate([np.arange(400), np.arange(100, 500)]).astype(np.uint64), np.ones(800, int))
    found.hash = near._mix(found.hash + np.uint64(12345))
    weights = np.where(found.hash % np.uint64(3) == 0, 2.0, 0.5)
    sampled = near.Sampler(2000).sample(found, weights, 2)
    want = near.weighted_jaccard(
        near.Shingled(np.zeros(400, int), found.hash[:400], found.count[:400]),
        near.Shingled(np.zeros(400, int), np.sort(found.hash[400:]), found.count[400:]),
        np.zeros(near.FEATURES),
        1,
    )[0]
    ones = near.Sampler(2000).sample(found, np.zeros(800), 2)
    assert abs((ones[0] == ones[1]).mean() - want) < 0.04
    assert 0.4 < (sampled[0] == sampled[1]).mean() < 0.8


def test_chunks_change_nothing(monkeypatch):
    draw = np.random.default_rng(1)
    hashes, offsets = draw.integers(0, 1 << 62, 5000), np.array([0, 0, 3, 40, 4000, 5000])
    found = near.shingle(hashes, offsets)
    weight = np.zeros(len(found.text))
    whole = near.Sampler(16).sample(found, weight, 5)
    monkeypatch.setattr(near, "_CHUNK", 37)
    assert (near.Sampler(16).sample(found, weight, 5) == whole).all()
    assert (whole[0] == 0).all()


def test_one_of_each_group_stays(spark):
    words = [f"word{i}" for i in range(200)]
    rows = [(i, " ".join(words[:i] + ["changed"] + words[i + 1 :])) for i in range(100)]
    rows += [(1000, " ".join(reversed(words))), (1001, "a b c"), (1002, "a b c"), (1003, "a b d")]
    out = near.without_near(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in out.collect()) == [0, 1000, 1001, 1003]


def test_edge_rows(edges, nothing):
    out = near.without_near(edges).collect()
    assert out[0].asDict()["doc"] == "own doc"
    kept = Counter((r.doc_id, r.text) for r in out)
    blank = [r for r in EDGES if not (r[1] or "").split()]
    assert sum(kept[r[0], r[1]] for r in blank) == len(blank)
    assert kept[4, PROSE] + kept[4, PROSE + " again"] == 1 and kept[5, PROSE] == 0
    assert len(near.near_groups(edges).collect()) == len(EDGES)
    assert near.near_groups(nothing).collect() == [] == near.without_near(nothing).collect()


@pytest.mark.parametrize("n", [0, 1, 70])
def test_components_of_a_chain(spark, n):
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(100 + i, 500) for i in range(n)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == ({i: 0 for i in range(n + 1)} | {i: 100 for i in [*range(100, 100 + n), 500]} if n else {})


@pytest.mark.parametrize("shared, same", [(16, True), (15, False)])
def test_weights_are_of_shingles(shared, same):
    """Shingles that all documents hold weigh less than those of one; with
    equal counts 16 of 20 are exactly 0.8, and 15 are not."""
    hashes = near._mix(np.arange(1, 21, dtype=np.uint64))
    left = np.sort(hashes)
    right = np.sort(hashes[:shared])
    side = lambda h: near.Shingled(np.zeros(len(h), int), h, np.ones(len(h), int))
    both = hashes[:shared].view(np.int64)
    cuts = np.array([0, shared])
    n_docs = 10
    everywhere = np.full(shared, n_docs)
    weights = [near.idf_weights(side(h), both, everywhere, cuts, n_docs) for h in (left, right)]
    got = near.overlap(side(left), side(right), *weights, 1)[0]
    rare, common = math.log(11), math.log(2)
    assert got == pytest.approx(shared * common / (shared * common + (20 - shared) * rare))
    flat = [near.idf_weights(side(h), both, np.ones(shared, int), cuts, n_docs) for h in (left, right)]
    assert (near.overlap(side(left), side(right), *flat, 1)[0] >= 0.8 - 1e-9) == same


def test_counts_are_exact(spark):
    """Every shingle's documents, copies included, though there are more
    shingles than a table of 65,536 cells could tell apart."""
    long = [" ".join(f"{d}x{i}" for i in range(30_000)) for d in range(4)]
    rows = [(i, 1, t + " a b c d e") for i, t in enumerate(long)] + [(9, 3, "a b c d e"), (10, 1, "p q r s t")]
    classes = near.hashed_words(spark.createDataFrame(rows, "id long, copies long, text string"), "id", "copies")
    got = {r.id: r.counts for r in near.repeated_shingles(classes).collect()}
    assert got == {i: [7] for i in (0, 1, 2, 3, 9)}


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_shingles_move_by_part(spark, monkeypatch, parts):
    """No shingle is a row of a shuffle, whatever the texts are dealt out to."""
    plans = []
    write = near.saved

    def noted(df, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **options)

    monkeypatch.setattr(near, "saved", noted)
    monkeypatch.setattr(near, "_WORDS", 40)
    texts = [[i % 7, i % 5, i % 3, i % 2, *range(i % 11)] for i in range(90)]
    rows = [(i, 1 + i % 4 // 3, t) for i, t in enumerate(texts)] + [(90, 1, []), (91, 2, [1])]
    classes = spark.createDataFrame(rows, "id long, copies long, words array<long>").repartition(3)
    out = near.repeated_shingles(classes, 3, *[parts] * (parts != 64)).collect()
    own = {}
    for i, _, t in rows:
        w = np.array(t, np.int64)
        own[i] = near.shingle(w, np.array([0, len(w)]), 3).hash.view(np.int64).tolist()
    count = Counter()
    for i, copies, _ in rows:
        count.update({h: copies for h in own[i]})
    want = {i: {h: count[h] for h in hashes if count[h] > 1} for i, hashes in own.items()}
    assert {r.id: dict(zip(r.hashes, r.counts, strict=True)) for r in out} == {i: w for i, w in want.items() if w}
    assert not any("hashpartitioning(hash#" in p for p in plans)


def test_only_wanted_shingles_in_the_same_order():
    draw = np.random.default_rng(4)
    words = draw.integers(0, 50, 4000)
    offsets = np.append(np.sort(draw.integers(0, 4000, 90)), 4000)
    offsets[0] = 0
    every = near.shingle(words, offsets)
    assert np.array_equal(np.lexsort((every.hash, every.text)), np.arange(len(every.hash)))
    odd = lambda hashes: hashes % np.uint64(2) == 1
    some, fit = near.shingle(words, offsets, wanted=odd), odd(every.hash)
    for name in ("text", "hash", "count"):
        assert np.array_equal(getattr(some, name), getattr(every, name)[fit])
    # More texts than a short number counts.
    text, value = draw.integers(0, 1 << 17, 5000), draw.integers(0, 9, 5000).astype(np.uint64)
    assert np.array_equal(near._by_text(text, value), np.lexsort((value, text)))
