"""Linked fingerprints against holding every fingerprint against every other."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
import xxhash

from tests.llm.conftest import EDGES
from tidemark.llm import balls


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """The least member of the component of each fingerprint."""
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in distinct}


def expected(rows):
    """Rows (doc_id, fingerprint, component_id) of (doc_id, text)."""
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps)
    least = {}
    for (d, _), f in zip(rows, fps, strict=True):
        if d is not None:
            least[roots[f]] = min(d, least.get(roots[f], d))
    return Counter((d, f"{f:016x}", least.get(roots[f])) for (d, _), f in zip(rows, fps, strict=True))


def result(docs):
    out = balls.near_components(docs)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    return Counter(tuple(r) for r in out.collect())


def test_equals_all_pairs(docs, texts):
    want = expected(list(texts.items()))
    assert result(docs) == want
    assert sum(n for (d, _, c), n in want.items() if d != c) > 5


@pytest.mark.parametrize(("variants", "families"), [(1 << 21, 12), (30, 0)])
def test_links_of_fingerprints(spark, monkeypatch, variants, families):
    """Families around a fingerprint, and pairs at each distance; small groups
    are dealt out again until every bit is used."""
    monkeypatch.setattr(balls, "VARIANTS", variants)
    monkeypatch.setattr(balls, "FURTHER", 20)
    draw = random.Random(3)
    fps = [0, (1 << 64) - 1]
    for distance in range(8):
        for _ in range(families):
            base = draw.getrandbits(64)
            fps += [base, base ^ sum(1 << b for b in draw.sample(range(64), distance))]
    center = draw.getrandbits(64)
    fps += [center ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))) for _ in range(30 + 10 * families)]
    signed = [f - (1 << 64) if f >> 63 else f for f in set(fps)]
    rows = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in balls.close_links(rows).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    roots = plain_components(fps)
    # The links connect what all pairs connect.
    got = {f: f for f in roots}

    def find(f):
        while got[f] != f:
            f = got[f]
        return f

    for a, b in links:
        x, y = find(a), find(b)
        got[max(x, y)] = min(x, y)
    assert {f: find(f) for f in roots} == roots


def test_many_near_copies_give_few_links(spark):
    draw = random.Random(9)
    center = draw.getrandbits(62)
    family = list({center ^ sum(1 << b for b in draw.sample(range(62), 2)) for _ in range(1500)})
    links = balls.close_links(spark.createDataFrame([(f,) for f in family], "fp long"))
    assert len(family) - 1 <= links.count() < 100 * len(family)


def test_fingerprint_of_a_long_text_in_parts(monkeypatch):
    text = "\t".join(random.Random(1).choices(["Ab", "c", "dé", "EFG"], k=3000))
    whole = balls.fingerprint(text.encode())
    assert whole == plain_fingerprint(text)
    monkeypatch.setattr(balls, "PART", 7)
    assert balls.fingerprint(text.encode()) == whole


@pytest.mark.parametrize("text", ["", " \n", "one", "one two three", "a b c d", "A\x0bB\x1cC d", "\x00 \x85 x y z"])
def test_short_fingerprints(text):
    assert balls.fingerprint(text.encode()) == plain_fingerprint(text)


def test_edge_rows(edges, nothing):
    assert result(edges) == expected([(r[0], r[1]) for r in EDGES])
    assert balls.near_components(nothing).collect() == []
    alone = edges.where("doc_id is null and text is null")
    assert [tuple(r) for r in balls.near_components(alone).collect()] == [(None, "0" * 16, None)]
