"""Language identification against a plain PPM, and on held-out documents."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EDGES
from tidemark.llm import language
from tidemark.llm.queries import QUERIES

TEXTS = {
    "de": ["der hund und die katze sind im haus", "ich gehe über die straße"],
    "en": ["the dog and the cat are in the house", "i walk the street"],
}


def plain_bits(texts, text, order=language.ORDER):
    """Code length with a dictionary of counts for each context."""
    counts = defaultdict(Counter)
    for t in texts:
        raw = [None] * order + list(t.encode())
        for i in range(order, len(raw)):
            for k in range(order + 1):
                counts[tuple(raw[i - k : i])][raw[i]] += 1
    total, raw = 0.0, [None] * order + list(text.encode())
    for i in range(order, len(raw)):
        for k in range(order, -1, -1):
            seen = counts.get(tuple(raw[i - k : i]))
            if not seen:
                continue
            n, d = sum(seen.values()), len(seen)
            if raw[i] in seen:
                total -= math.log2(seen[raw[i]] / (n + d))
                break
            total -= math.log2(d / (n + d))
        else:
            total += 8
    return total


@pytest.mark.parametrize("text", ["the house", "die straße", "\x00\xff?", "x", "katze the"])
def test_code_length_equals_plain_version(text):
    # A byte that no language has seen counts as one outside of texts, which
    # this version calls by its own name.
    bits, sizes = language.score_texts(language.learn(TEXTS), pa.array([text]))
    assert sizes[0] == len(text.encode())
    if set(text.encode()) <= {b for v in TEXTS.values() for t in v for b in t.encode()}:
        np.testing.assert_allclose(bits[0], [plain_bits(TEXTS[k], text) for k in ("de", "en")], rtol=1e-5)
    else:
        assert (bits[0] > 8).all()


def test_long_texts_in_runs(monkeypatch):
    model = language.learn(TEXTS)
    column = pa.array(["the house " * 50, None, "", "die straße", "x" * 99])
    whole, _ = language.score_texts(model, column)
    monkeypatch.setattr(language, "_RUN", 64)
    np.testing.assert_allclose(language.score_texts(model, column)[0], whole, rtol=1e-6)
    np.testing.assert_allclose(language.score_texts(model, column[3:])[0], whole[3:], rtol=1e-6)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op8_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    (share,) = rows.where("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert share > 0.97


def test_edge_rows(edges, nothing):
    model = language.fit(edges, F.lit(True))
    out = language.identify(edges, model).collect()
    assert len(out) == len(EDGES)
    assert {r.lang_pred for r in out if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert all(r.score == 0 and r.bits_per_byte is None for r in out if r.lang_pred == "und")
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.doc for r in out} == {"own doc"}
    kept = language.accepted(edges, model)
    assert kept.columns == [c for c in edges.columns if c != "score"]
    assert {r.doc_id for r in kept.collect()} >= {4, 5, 6}
    empty = language.fit(nothing, F.lit(True))
    assert language.identify(nothing, model).collect() == []
    assert {r.lang_pred for r in language.identify(edges, empty).collect()} == {"und"}


def test_training_is_bounded(docs):
    found = language.training_texts(docs, F.lit(True), train_texts=5, train_bytes=3000).groupBy("lang")
    for row in found.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).collect():
        assert row.n == 1 or (row.n <= 5 and row.b <= 3000)


def test_long_texts_keep_no_others_out(spark):
    rows = [("en", f"{i} " + "x" * 2_000_000) for i in range(8)] + [("en", f"short text {i}") for i in range(50)]
    rows += [("fr", "é" * 3_000_000)]
    found = language.training_texts(spark.createDataFrame(rows, "lang string, text string"), F.lit(True)).collect()
    assert sorted(r.text for r in found if r.lang == "en") == sorted(t for _, t in rows[8:58])
    assert [len(r.text.encode()) for r in found if r.lang == "fr"] == [500_000]
