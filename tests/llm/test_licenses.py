"""License scans: exact phrases against a plain scan, edited notices."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from tests.llm.conftest import EDGES
from tidemark.llm import licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def base(rows):
    return [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows]


def test_phrases(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = licenses.licensed(df).collect()
    got = {r.doc_id: b for r, b in zip(rows, base(rows), strict=True)}
    assert got == {r.doc_id: plain(r.text) for r in df.collect()}
    assert any(r.n_base for r in rows)
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


NOTICE = dict((label, text) for text, label in licenses.TEMPLATES if len(text.split()) > 15)
APACHE = NOTICE["apache"].split()


@pytest.mark.parametrize(
    "text, labels",
    [
        ("MIT License", "mit"),
        ("the gnu general public license and cc-by", "cc-by,gpl"),
        ("gnu, general: public\nLICENSE", "gpl"),
        ("gnu general and public license", ""),
        ("GNU Lesser General Public License", "lgpl"),
        (" ".join(APACHE), "apache"),
        # One word changed, one left out, two put in.
        (" ".join([*APACHE[:6], "program", *APACHE[7:12], *APACHE[13:18], "oh", "well", *APACHE[18:]]), "apache"),
        (" ".join(APACHE[:8]), ""),
        ("x ".join(APACHE), ""),
        ("mİt lİcense KGNU general public license", "")
    ],
)
def test_labels(spark, text, labels):
    df = spark.createDataFrame([(1, "before it " + text + " and after")], "doc_id long, text string")
    (row,) = licenses.licensed(df).collect()
    assert row.labels == labels
    assert base([row]) == [plain("before it " + text + " and after")]


def test_spans(spark):
    text = " ".join(["w"] * 10 + APACHE + ["w"] * 30 + APACHE)
    places = licenses.spans(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    found = sorted((r["first"], r["last"]) for r in places.where("NOT exact").collect())
    n = len(APACHE)
    assert found == [(10, 9 + n), (40 + n, 39 + 2 * n)]


def test_edge_rows(edges, nothing):
    rows = licenses.licensed(edges).collect()
    assert Counter((r.doc_id, *b) for r, b in zip(rows, base(rows), strict=True)) == Counter((r[0], *plain(r[1])) for r in EDGES)
    assert {(r.labels, r.score) for r in rows} == {("", 0.0)}
    assert licenses.licensed(nothing).collect() == []
