from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use themselves.
CLASHES = ("doc", "row", "key", "id", "pos", "n", "words", "part", "bucket", "root", "ids", "kind", "votes", "n_lines", "score")

PROSE = "the quick brown fox jumps over the lazy dog and runs far away into the deep green wood"
EDGES = [
    (None, None, None, None, None),
    (1, None, "en", "a", 0),
    (2, "", "en", None, 0),
    (3, " \n\t \r\n", "en", "a", 6),
    (4, PROSE, "en", "a", len(PROSE)),
    (4, PROSE, "en", "a", len(PROSE)),
    (4, PROSE + " again", "en", "b", len(PROSE) + 6),
    (5, PROSE, None, "b", len(PROSE)),
    (None, PROSE + "\n" + PROSE, "en", None, 2 * len(PROSE) + 1),
    (6, "one", "en", "a", 3),
    (7, "Ünï cödé \U0001f600\u0000  x", "de", "c", 16),
    (8, "123 456 !!! ### $$$", None, "c", 19),
    (9, "\n".join(f"line {'abc'[i % 3]} number {i} of a very long text with words" for i in range(3000)), "en", "a", 0),
    (10, "x" * 3_000, "fr", "b", 3_000),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def edges(spark):
    """Rows with nulls, blanks, ties, copies and long texts, and extra columns."""
    df = spark.createDataFrame(EDGES, COLUMNS)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
