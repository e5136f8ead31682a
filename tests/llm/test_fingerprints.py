"""Fingerprints: entropies by counting, edits and neighbours by brute force."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import EDGES
from tidemark.llm import fingerprints as fp


def test_entropy_classes():
    draw = np.random.default_rng(3)
    data = np.concatenate([draw.integers(0, k, 200) for k in (1, 2, 30, 256)]).astype(np.uint8)
    got = fp.entropy_classes(data)
    for i in range(len(data) - 63):
        bits = -sum(c / 64 * math.log2(c / 64) for c in Counter(data[i : i + 64].tolist()).values())
        assert abs(got[i] - 1000 * bits / 6) <= 1.001
    assert len(fp.entropy_classes(data[:63])) == 0


def plain_features(text, ranks):
    """Selected windows of a text, by a loop over all neighbourhoods."""
    if len(text) < fp.SHORT:
        size = min(fp.SHORT_WINDOW, len(text))
        return {text[i : i + size] for i in range(len(text) - size + 1)} if text else set()
    rank = ranks[fp.entropy_classes(np.frombuffer(text, np.uint8))]
    points = Counter()
    for i in range(len(rank) - fp.NEIGHBOURS + 1):
        best = min(range(i, i + fp.NEIGHBOURS), key=lambda j: (rank[j], j))
        if rank[best] < fp._NEVER:
            points[best] += 1
    chosen = {i for i, n in points.items() if n >= fp.POPULAR}
    if not chosen:
        top = min(points or range(len(rank)), key=lambda i: (-points[i], i) if points else (rank[i], i))
        chosen = {top} if rank[top] < fp._NEVER else set()
    return {text[i : i + fp.WINDOW] for i in chosen}


def test_selected_features(texts):
    raw = [t.encode() for t in texts.values() if t][:40]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ranks = fp.rarity(np.bincount(fp.entropy_classes(data), minlength=fp.CLASSES))
    starts = np.concatenate([[0], np.cumsum([len(t) for t in raw])[:-1]])
    text, value = fp.select(data, starts, ranks)
    names = {}
    for i, t in enumerate(raw):
        found = plain_features(t, ranks)
        assert (text == i).sum() == len(found)
        one = fp.select(np.frombuffer(t, np.uint8), np.zeros(1, np.int64), ranks)[1]
        assert sorted(one) == sorted(value[text == i])
        for f in found:
            names.setdefault(f, set()).add(i)
    # Equal features have equal hashes wherever they stand.
    assert len(set(value.tolist())) == len(names)


def test_filters_hold_what_was_put_in():
    value = np.random.default_rng(5).integers(0, 1 << 63, 400).astype(np.uint64)
    (chain,) = fp.filters(np.zeros(400, np.int64), value, 1)
    assert chain.shape == (3, fp.BITS // 8)
    for i, v in enumerate(value.tolist()):
        bits = np.unpackbits(chain[i // fp.FULL], bitorder="little")
        assert all(bits[(v >> 11 * k) % fp.BITS] for k in range(fp.HASHES))
    assert fp.likeness(chain, chain) == 1 == fp.likeness(chain[:0], chain[:0])
    assert fp.likeness(chain, chain[:0]) == 0
    assert fp.likeness(chain, chain[1:]) == fp.likeness(chain[1:], chain) == 1
    other = fp.filters(np.zeros(400, np.int64), value[::-1] ^ np.uint64(0x5555555555555555), 1)[0]
    assert fp.likeness(chain, other) < 0.1


def edits(rows):
    """(doc_id, text, edited) of rows in order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out = []
    for i, (doc, text, *_) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        out.append((doc, text, text[: len(text) - cut] + after[:cut]))
    return out


@pytest.mark.parametrize("partitions", [None, 9, 1])
def test_edits_and_neighbours(docs, texts, partitions):
    got = {r.doc_id: r for r in fp.fingerprinted(docs, partitions).collect()}
    prints = {}
    for doc, text, edited in edits(texts.items()):
        row = got.pop(doc)
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        assert 0 <= row.near_next <= 1 and 0 <= row.near_edited <= 1
        if len(text) > 1000:
            assert row.near_edited > 0.4
    assert not got
    assert len(set(prints.values())) == len(prints)


def test_edge_rows(edges, nothing, spark):
    got = fp.fingerprinted(edges, 4).collect()
    key = lambda x: (str(x[0]), x[1], x[2])
    want = [(d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e in edits(EDGES)]
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(want, key=key)
    assert {r.fingerprint for r in got if r.n_chars == 0} == {""}
    assert {r.near_edited for r in got if r.n_chars == 0} == {1.0}
    assert fp.fingerprinted(nothing).collect() == []
    (one,) = fp.fingerprinted(spark.createDataFrame([(1, "abcdefgh" * 60)], "doc_id long, text string")).collect()
    assert one.near_next == 1 and one.near_edited > 0.5
