from __future__ import annotations

import re

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.terms import leading_words, term_count, term_pattern
from tidemark.operators.mentions import find_mentions
from tidemark.sources.dimensions import TRACKED, Project

TERMS = [
    "Spark", "Duck DB", "Weights & Biases", "Evidence.dev", "Neo 4j", "SQL Server", "C++", ".NET",
    "a b c", "Monte Carlo Data", "Öl", "foo-", "rock 'n' roll", 'x"y', "back\\slash",
]


def python_count(term: str, text: str) -> int:
    words = re.split(r"[-\s]+", term)
    pattern = r"\b" + r"[-\s]?".join(re.escape(w) for w in words) + r"\b"
    return len(re.findall(pattern, text, re.IGNORECASE))


@pytest.mark.parametrize(
    ("term", "text", "expected"),
    [
        ("Spark", "Spark spark-SPARK sparkling", 3),
        ("Duck DB", "DuckDB duck-db duck db", 3),
        ("Weights & Biases", "Weights&Biases weights & biases", 2),
        ("Evidence.dev", "evidencexdev", 0),
        ("Spark", "éspark sparké spark_x 2spark", 0),
        ("Spark", "", 0),
        ("Spark", None, None),
        ("Neo 4j", "neo4j neo  4j NEO\t4J", 2),
        ("Spark", "ſpark SPARK", 2),
        (".NET", "asp.net .net", 1),
        ("Spark", "sparḱ x", 1),
        ("Spark", "x spark spark", 2),
        ("Duck DB", "duck\x1cdb", 1),
        ("foo-", "foo\u0301 foo-bar foo- xfoo foo", 4),
        ("-foo", "a-foo foo\u0301 -foo", 3),
    ],
)
def test_term_count(spark, term, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(term_count(F.col("text"), term)).first()[0] == expected
    if text is not None:
        assert python_count(term, text) == expected


def test_leading_words():
    assert leading_words("Duck DB") == ["duck", "duckdb"]
    assert leading_words("Evidence.dev") == ["evidence"]
    assert leading_words("Weights & Biases") == ["weights"]
    assert leading_words("a b c") == ["a", "ab", "abc"]
    assert leading_words(".NET") is None
    assert leading_words("Öl") is None
    with pytest.raises(ValueError):
        term_pattern("- -")


_PIECES = st.sampled_from(
    ["spark", "SPARK", "Duck", "db", "DB", "weights", "&", "biases", "evidence.dev", "neo", "4j",
     "c++", ".net", "rock", "'n'", "roll", 'x"y', "back\\slash", "a", "b", "c", "foo", "öl", "monte", "carlo", "data", "sql", "server", "İ", "ı",
     "ſ", "K", "é", "_", "́", "9", "٣", "漢"]
)
_JOINS = st.sampled_from(["", " ", "-", "  ", "\n", " ", ".", ",", "\x1d", "—"])


# Every example is a Spark job, so a failing one is not made smaller.
@settings(max_examples=12, deadline=None, phases=(Phase.reuse, Phase.generate))
@given(st.lists(st.lists(st.tuples(_PIECES, _JOINS), max_size=14), min_size=40, max_size=60))
def test_mentions_equal_python(spark, texts):
    texts = ["".join(a + j for a, j in pieces) for pieces in texts]
    projects = [Project(t, (t,)) for t in TERMS]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for i, found in find_mentions(df, projects).select("i", "projects_mentions").collect():
        expected = [(t, python_count(t, texts[i])) for t in TERMS]
        assert [tuple(m) for m in found or []] == [(t, n) for t, n in expected if n], texts[i]


def test_tracked_projects_in_order(spark):
    text = "Glue Catalog on AWS, duckdb with PyArrow and arrow; kafka, Kafka-KAFKA"
    df = spark.createDataFrame([(text,), ("nothing of note",), (None,), ("",)], "text string")
    found = [r[0] for r in find_mentions(df, TRACKED).select("projects_mentions").collect()]
    assert [tuple(m) for m in found[0]] == [
        ("Apache Arrow", 2), ("Apache Kafka", 3), ("DuckDB", 1), ("AWS Glue", 1), ("AWS Glue Catalog", 1)
    ]
    assert found[1:] == [None, None, None]


def test_only_unguarded_terms(spark):
    df = spark.createDataFrame([("asp.net",), ("none",)], "text string")
    found = find_mentions(df, [Project("N", (".NET",))]).select("projects_mentions").collect()
    assert [r[0] and [tuple(m) for m in r[0]] for r in found] == [[("N", 1)], None]
