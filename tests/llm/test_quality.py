"""Measures, votes and learned accuracies against plain versions."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EDGES
from tidemark.llm import quality

SPACE = " \t\n\r\x0b\x0c"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def measures(df):
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in df]


def test_measures(docs, texts):
    rows = quality.filtered(docs).collect()
    assert {r.doc_id: m for r, m in zip(rows, measures(rows), strict=True)} == {d: plain(t) for d, t in texts.items()}
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= quality.THRESHOLD)


@pytest.mark.parametrize("text", ["a b c d e f g h " * 2, "x " * 9, "x " * 8, "a b c d e f g h i " * 3 + "z " + "b c d e f g h i", ""])
def test_repeated_words(spark, text):
    (row,) = quality.measured(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id").collect()
    assert row.n_repeat_words == plain(text)[4]


def plain_accuracies(patterns, n_rules):
    def within(part, whole, low, high):
        return max(low, min(high, part / whole)) if whole > 0 else max(low, min(high, 0.8))

    prior, good, bad = 0.8, [0.8] * n_rules, [0.8] * n_rules
    for _ in range(quality.ROUNDS):
        post = {}
        for votes in patterns:
            odds = math.log(prior / (1 - prior))
            for g, b, v in zip(good, bad, votes, strict=True):
                odds += math.log(g / (1 - b)) if v == 1 else math.log((1 - g) / b) if v == -1 else 0
            post[votes] = 1 / (1 + math.exp(-odds))
        for j in range(n_rules):
            of = lambda right, p: sum(n * p(v) for v, n in patterns.items() if v[j] in right)
            is_good, is_bad = (lambda v: post[v]), (lambda v: 1 - post[v])
            good[j] = within(of((1,), is_good), of((1, -1), is_good), 0.001, 0.999)
            bad[j] = max(within(of((-1,), is_bad), of((1, -1), is_bad), 0.001, 0.999), 1 - good[j])
        total = sum(patterns.values())
        prior = within(sum(n * post[v] for v, n in patterns.items()), total, 0.01, 0.99)
    return prior, good, bad


def test_learned_accuracies(spark):
    patterns = {(1, 1, 1): 800, (1, 1, 0): 60, (1, -1, -1): 90, (1, -1, 1): 10, (-1, -1, -1): 15, (0, 0, 1): 25}
    df = spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<int>, n long")
    row = quality.learn_accuracies(df, 3).first()
    prior, good, bad = plain_accuracies(patterns, 3)
    assert row.prior == pytest.approx(prior) and row.on_good == pytest.approx(good) and row.on_bad == pytest.approx(bad)
    # A rule that always votes good says little, the two that agree a lot.
    assert row.on_bad[1] > 0.8 > row.on_bad[0]


def test_labels_that_it_never_saw(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.filtered(spark.read.parquet(f"{sf}/documents.parquet")).where("NOT base_failed")
    by = out.select("doc_id", "kept").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").groupBy("quality")
    kept = {r.quality: r.share for r in by.agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.97 and kept[0] < 0.1


def test_edge_rows(edges, nothing):
    rows = quality.filtered(edges).collect()
    want = Counter((r[0], *plain(r[1])) for r in EDGES)
    assert Counter((r.doc_id, *m) for r, m in zip(rows, measures(rows), strict=True)) == want
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 6))
    assert quality.filtered(nothing).collect() == []
