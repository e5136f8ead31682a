"""Repeated passages against counting every passage."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import EDGES
from tidemark.llm import repeats


def plain(texts, length):
    """(removed runs, kept bytes) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        cover = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        mask = np.cumsum(cover[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(int), [0]])))
        out.append((list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), bytes(np.frombuffer(b, np.uint8)[~mask])))
    return out


def spans(df, **options):
    return {r.doc_id: ([(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in repeats.without_repeats(df, **options).collect()}


def test_equals_counting(docs, texts):
    want = dict(zip(texts, plain(texts.values(), repeats.LENGTH), strict=True))
    assert sum(bool(s) for s, _ in want.values()) > 5
    assert spans(docs) == want


@pytest.mark.parametrize("large", [4096, 1])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "xyä"])
def test_small_passages(spark, monkeypatch, letters, large):
    draw = random.Random(letters)
    base = ["".join(draw.choices(letters, k=draw.randint(0, 160))) for _ in range(25)]
    # Parts of each other, in other surroundings.
    texts = base + [x[draw.randint(0, 30) :] + y[: draw.randint(0, 99)] for x, y in zip(base, base[3:], strict=False)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert spans(rows, length=20, size=6, large=large) == dict(enumerate(plain(texts, 20)))


def test_long_texts_in_parts(monkeypatch):
    draw = random.Random(7)
    text = "".join(draw.choices("abcd", k=5000)).encode()
    whole = list(repeats._all_anchors([text], 20, 6))
    monkeypatch.setattr(repeats, "_RUN", 64)
    parts = list(repeats._all_anchors([text, b"", b"abc"], 20, 6))
    for a, b in zip(whole[0], [np.concatenate(c) for c in zip(*parts, strict=True)], strict=True):
        assert (a == b).all()


def test_maximal_repeats_are_all_and_maximal():
    draw = random.Random(11)
    for _ in range(40):
        contexts = [("".join(draw.choices("ab", k=draw.randint(0, 9))).encode(), "".join(draw.choices("ab", k=draw.randint(1, 9))).encode()) for _ in range(draw.randint(2, 9))]
        want = set()
        for left in range(10):
            for right in range(10):
                if left + right >= 5:
                    groups = {}
                    for i, (a, b) in enumerate(contexts):
                        if len(a) >= left and len(b) >= right:
                            groups.setdefault((a[:left], b[:right]), []).append(i)
                    for g in groups.values():
                        before = {contexts[i][0][left : left + 1] for i in g}
                        after = {contexts[i][1][right : right + 1] for i in g}
                        if len(g) > 1 and (len(before) > 1 or before == {b""}) and (len(after) > 1 or after == {b""}):
                            want.add((tuple(g), left, right))
        got = [(tuple(sorted(m)), a, b) for m, a, b in repeats.maximal_repeats(contexts, 5)]
        assert len(got) == len(set(got)) and set(got) == want


def test_groups_have_all_occurrences(spark):
    draw = random.Random(5)
    make = lambda n: "".join(draw.choices("abcdefghijklmnop", k=n))
    passage = make(230)
    rows = [(i, make(149) + str(i) + passage + str(9 - i) + make(149)) for i in range(6)]
    found = repeats.occurrences(spark.createDataFrame(rows, "doc_id long, text string"))
    sizes = found.where("length = 230").groupBy("group").count().collect()
    assert {r["count"] for r in sizes} == {6}
    # Other groups are what the contexts of other anchors hold of it.
    assert all(r.start >= 150 and r.start + r.length <= 380 for r in found.collect())


def test_edge_rows(edges, nothing):
    rows = repeats.without_repeats(edges).collect()
    raw = [(r[1] or "").encode() for r in EDGES]
    want = Counter((r[0], len(b), kept) for r, b, (_, kept) in zip(EDGES, raw, plain([r[1] for r in EDGES], 200), strict=True))
    assert Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in rows) == want
    assert repeats.without_repeats(nothing).collect() == []
    two = edges.where("doc_id = 10")
    assert {bytes(r.kept) for r in repeats.without_repeats(two.union(two)).collect()} == {b""}


def test_repeats_leave_a_few_at_a_time(monkeypatch):
    """Contexts that share more and more have far more repeats than rows: a
    task does not hold them all."""
    monkeypatch.setattr(repeats, "_SENT", 50)
    rows = [(1, d, 0, 0, b"x" * (20 + d) + bytes([65 + d])) for d in range(40)] + [(2, 90, 0, 0, b"y" * 30)]
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, names=["route", "doc", "at", "left", "raw"])
    sent = list(repeats._compare(20, repeats._group)(iter([batch])))
    assert max(b.num_rows for b in sent) == 50 and sum(b.num_rows for b in sent) > 10 * len(rows)
    whole = [r for group in (rows[:40], rows[40:]) for r in repeats._group(group, 20)]
    assert [(r["group"], r["doc"], r["right"]) for b in sent for r in b.to_pylist()] == [(g, d, n) for g, d, _, _, n in whole]


def test_texts_become_objects_a_few_at_a_time(monkeypatch):
    """Anchors are those of all texts, however many rows a batch has."""
    draw = random.Random(3)
    texts = ["".join(draw.choice("abcd ") for _ in range(draw.randint(0, 400))) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(texts)], names=["doc", "text"])
    found, most = [], []
    anchors_of = repeats._all_anchors
    monkeypatch.setattr(repeats, "_all_anchors", lambda group, *a: most.append(len(group)) or anchors_of(group, *a))
    for piece in (256, 7):
        monkeypatch.setattr(repeats, "_PIECE", piece)
        most.clear()
        found.append([b.to_pylist() for b in repeats._find(30, 10)(iter([batch]))])
        assert max(most) == min(piece, 60)
    assert found[0] == found[1] and found[0]


def test_repeats_of_a_context_are_one_run():
    """What covers a context grows with the contexts, not with their repeats."""
    rows = [(1, d, 100, 5, bytes([65 + d]) + b"wxyz" + b"x" * (20 + d) + bytes([65 + d])) for d in range(40)]
    want = {}
    n = 0
    for _, doc, at, left, right in repeats._group(rows, 20):
        want.setdefault((doc, at), set()).update(range(at - left, at + right))
        n += 1
    got = list(repeats._cover(rows, 20))
    assert {(doc, at): set(range(at - left, at + right)) for _, doc, at, left, right in got} == want
    assert len(got) == len(rows) < n / 10


def by_repeats(contexts, length):
    """The widest of all maximal repeats of each context."""
    out = {}
    for members, left, right in repeats.maximal_repeats(contexts, length):
        for m in members:
            back, on = out.get(m, (0, 0))
            out[m] = max(back, left), max(on, right)
    return out


@pytest.mark.parametrize(("few", "paired"), [(6, 512), (100, 512), (2, 512), (2, 1)])
def test_widest_equals_the_widest_of_all_repeats(monkeypatch, few, paired):
    monkeypatch.setattr(repeats, "_FEW", few)
    monkeypatch.setattr(repeats, "_PAIRED", paired)
    for seed in range(200):
        draw = random.Random(seed)
        letters, length = draw.choice([b"ab", b"a\0", b"abc"]), draw.choice([4, 6, 10])
        base = [bytes(draw.choices(letters, k=12)) for _ in range(3)]

        def part():
            out = bytearray(draw.choice(base))
            for _ in range(draw.randrange(3)):
                out[draw.randrange(12)] = draw.choice(letters)
            return bytes(out[: draw.randrange(13)])

        contexts = [(part(), part()) for _ in range(draw.choice([1, 2, 3, 7, 30]))]
        assert {m: both for m, *both in ((m, left, right) for m, left, right in repeats.widest(contexts, length))} == {
            m: list(both) for m, both in by_repeats(contexts, length).items()
        }


def test_nested_repeats_are_not_gone_through_one_by_one(monkeypatch):
    """Contexts that share more and more: before, each of the nested repeats
    was sorted and compared again, byte by byte, which grew with the square."""
    rows = [(0, i, 0, 0, b"a" * (100 + i) + b"b" * (200 - i)) for i in range(180)]
    calls = []
    common = repeats.common
    monkeypatch.setattr(repeats, "common", lambda a, b: calls.append(1) or common(a, b))
    assert len(list(repeats._cover(rows, 200))) == 80
    assert len(calls) < 2 * len(rows)
