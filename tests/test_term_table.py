from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks import content
from checks.registry import ORACLE
from tests.test_terms import TERMS, python_count
from tidemark.functions.terms import pattern_column, term_pattern
from tidemark.operators.mentions import find_mentions
from tidemark.operators.term_table import find_mentions_by_table
from tidemark.sources.dimensions import TRACKED, Project, project_rows

PIECES = [
    "spark", "SPARK", "Duck", "db", "DB", "weights", "&", "biases", "evidence.dev", "neo", "4j", "c++", ".net",
    "rock", "'n'", "roll", 'x"y', "back\\slash", "a", "b", "c", "foo", "öl", "ÖL", "monte", "carlo", "data", "sql",
    "server", "İ", "ı", "ſ", "K", "é", "_", "́", "9", "٣", "漢", "ς", "Σ", "ß", "ẞ",
]
JOINS = ["", " ", "-", "  ", "\n", " ", ".", ",", "\x1d", "—"]


def found_by_table(df, projects, **options):
    out = find_mentions_by_table(df, projects, **options)
    return {r.i: [tuple(m) for m in r.projects_mentions or []] for r in out.collect()}


def in_order(spark, projects):
    rows = [(i, p.name, list(p.terms)) for i, p in enumerate(projects)]
    return spark.createDataFrame(rows, "place long, project_name string, project_search_terms array<string>")


def test_patterns_match_alike(spark):
    terms = [*TERMS, "-foo", "a  b", "Σς"]
    df = spark.createDataFrame([(t,) for t in terms], "term string")
    texts = ["".join(random.Random(i).choices(PIECES + JOINS, k=12)) for i in range(200)]
    pairs = df.withColumn("pattern", pattern_column(F.col("term"))).crossJoin(
        spark.createDataFrame([(t,) for t in texts], "text string")
    )
    counted = pairs.select("term", "text", F.regexp_count("text", F.col("pattern")).alias("n"))
    plain = {t: spark.createDataFrame([(x,) for x in texts], "text string").select(
        F.collect_list(F.regexp_count("text", F.lit(term_pattern(t))))).first()[0] for t in terms}
    got = {t: {} for t in terms}
    for term, text, n in counted.collect():
        got[term][text] = n
    for t in terms:
        assert sorted(plain[t]) == sorted(got[t][x] for x in texts), t


def test_random_texts_equal_python(spark):
    draw = random.Random(7)
    terms = [*TERMS, "öl c", "foo-bar", "Straße", "ΟΔΟΣ", "data data", "DuckDB", "roll"]
    texts = ["".join(draw.choice(PIECES) + draw.choice(JOINS) for _ in range(draw.randrange(15))) for _ in range(400)]
    texts += ["ſpark spark SPARK", "SPARK spark", "SPARK spark", "Duck-DB sqlserver SQL server"]
    texts += ["ΟΔΟΣ οδος οδοσ", "STRAẞE straße STRASSE", "data data data-data", "foobar foo-bar", "", "duck-db"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    projects = [Project(t, (t,)) for t in terms]
    got = found_by_table(df, in_order(spark, projects), position="place")
    plain = find_mentions(df, projects).collect()
    assert got == {r.i: [tuple(m) for m in r.projects_mentions or []] for r in plain}
    for i, text in enumerate(texts):
        ascii_terms = [t for t in TERMS if t.isascii()]
        expected = [(t, n) for t in ascii_terms if (n := python_count(t, text))]
        assert [m for m in got[i] if m[0] in ascii_terms] == expected, text


def test_tracked_projects_equal_the_plan_form(spark):
    draw = random.Random(3)
    terms = [t for p in TRACKED for t in p.terms]
    texts = [
        " ".join(draw.choice([draw.choice(terms), draw.choice(terms).replace(" ", draw.choice(["", "-"])), "and"]) for _ in range(9))
        for _ in range(300)
    ]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "i int, text string")
    got = found_by_table(df, in_order(spark, TRACKED), position="place")
    plain = find_mentions(df, TRACKED).collect()
    assert got == {r.i: [tuple(m) for m in r.projects_mentions or []] for r in plain}
    assert sum(map(len, got.values())) > 1000


def test_a_hundred_thousand_terms(spark):
    """Terms that share their first words; the plan does not grow with them."""
    words = [f"w{i}" for i in range(46)]
    many = spark.range(100_000).select(
        F.concat(F.lit("p"), "id").alias("project_name"),
        F.array(F.concat_ws(" ", F.lit("the"), *[F.concat(F.lit("w"), F.expr(f"(id div {46**k}) % 46")) for k in range(4)])).alias(
            "project_search_terms"
        ),
    )
    draw = random.Random(1)
    texts = [" ".join(["the", *draw.choices(words, k=4), draw.choice(["", "x"])] * 3) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = found_by_table(df, many)
    terms = {" ".join(["the", *(f"w{i // 46**k % 46}" for k in range(4))]): f"p{i}" for i in range(100_000)}
    for i, text in enumerate(texts):
        seen = re.findall(r"the(?: w\d+){4}", text)
        expected: dict[str, int] = {}
        for one in seen:
            if one in terms:
                expected[terms[one]] = expected.get(terms[one], 0) + 1
        assert dict(got[i]) == expected
    assert any(got.values())
    plan = lambda d, p: len(find_mentions_by_table(d, p)._jdf.queryExecution().optimizedPlan().toString())
    few = many.limit(7).withColumn("project_name", F.col("project_name"))
    assert plan(df, many) < 1.2 * plan(df, few)


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, "spark spark", "x"), (2, None, "y"), (3, "", "z"), (4, "spark spark", "u")], "i int, text string, projects_mentions string")
    rows = [("S", ["spark", "spark", None]), ("N", None), ("E", [])]
    projects = spark.createDataFrame(rows, "project_name string, project_search_terms array<string>")
    assert found_by_table(df, projects) == {1: [("S", 4)], 2: [], 3: [], 4: [("S", 4)]}
    assert found_by_table(df, projects.limit(0)) == {1: [], 2: [], 3: [], 4: []}
    assert found_by_table(df.limit(0), projects) == {}
    assert find_mentions_by_table(df, projects).columns == ["i", "text", "projects_mentions"]
    bad = spark.createDataFrame([("B", ["- -"])], projects.schema)
    with pytest.raises(PySparkException, match="without a word"):
        found_by_table(df, bad)


def test_project_rows_serve_as_a_table(spark):
    df = spark.createDataFrame([(1, "duckdb with Kafka")], "i int, text string")
    got = found_by_table(df, project_rows(spark))
    assert got == {1: [("Apache Kafka", 1), ("DuckDB", 1)]}


def test_words_do_not_leave_their_text_to_be_counted(spark):
    """Texts move once, whole; the rows that a dictionary of one-word terms
    makes of their words are not shuffled before they meet the terms."""
    df = spark.createDataFrame([(i, "spark duckdb kafka " * 3) for i in range(20)], "i int, text string")
    projects = spark.createDataFrame([("S", ["spark"]), ("K", ["kafka"])], "project_name string, project_search_terms array<string>")
    plan = find_mentions_by_table(df, projects)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(" in line for line in plan.split("\n")) <= 2


def test_a_project_of_one_word_and_more_and_letters_that_fold_to_ascii(spark):
    texts = ["with this with", "Kafka kafka", "kafKa", "with-this with thıs", "kafka with"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    names = {"B": ["with", "with this"], "K": ["kafka"]}
    projects = spark.createDataFrame(list(names.items()), "project_name string, project_search_terms array<string>")
    for n in (names, {"K": names["K"]}):
        got = found_by_table(df, projects.where(F.col("project_name").isin(*n)))
        for i, text in enumerate(texts):
            want = {p: sum(python_count(t, text) for t in ts) for p, ts in n.items()}
            assert dict(got[i]) == {p: c for p, c in want.items() if c}


def test_terms_of_one_word_in_any_script_are_counted_by_words(spark):
    """Words that fold alike, but that an expression tells apart, included."""
    terms = ["straße", "strasse", "\u00f6l", "\u00e9", "ss", "\u017f", "\u03c3", "\u03bf\u03b4\u03bf\u03c2", "k", "\u212aelvin", "x1", "_", "9", "\u0663", "\u6f22", "\U00010400a"]
    texts = [
        "Straße STRASSE STRA\u1e9eE strasse stra\u017f\u017fe", "\u00d6L \u00f6l-\u00f6l \u00f6ls", "\u00e9 \u00c9 e\u0301 \u00e9\u00e9", "SS ss \u017f\u017f \u00df s \u017f S",
        "\u039f\u0394\u039f\u03a3 \u03bf\u03b4\u03bf\u03c2 \u03bf\u03b4\u03bf\u03c3 \u03c3 \u03c2 \u03a3", "K k \u212a kelvin \u212aELVIN", "x1 X1 x 1 _ __ 9 \u0663 \u6f22 \u6f22\u5b57 \U00010428A \U00010400a",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    projects = [Project(t, (t,)) for t in terms]
    got = found_by_table(df, in_order(spark, projects), position="place")
    plain = find_mentions(df, projects).collect()
    assert got == {r.i: [tuple(m) for m in r.projects_mentions or []] for r in plain}
    assert all(got.values())


def test_every_word_of_a_document_is_a_term(spark, tmp_path):
    """Short ones, digits and other letters than those from a to z included."""
    documents = [(1, "F\u00fcr f\u00fcr \u00e9 a b2 12 the_end"), (2, "ab \u6f22\u5b57 THE the f\u00fcr"), (2, "ab"), (3, None), (4, "")]
    turns = [(1, 0, "user", "\u00c9 f\u00fcr 12"), (1, 1, "user", "not in documents a")]
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = Counter(tuple(r) for r in content.term_table_of_all_words(spark, str(tmp_path)).select("project", "texts", "mentions").collect())
    connection = duckdb.connect()
    for name in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = connection.execute(f"SELECT project, texts, mentions FROM ({ORACLE['term_table_of_all_words']})").fetchall()
    assert got == Counter(want)
    assert {"f\u00fcr", "\u00e9", "a", "b2", "12", "the_end", "ab", "\u6f22\u5b57", "the"} == {project for project, _, _ in got}
