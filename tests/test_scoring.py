from __future__ import annotations

import pytest

from tidemark.operators.score_store import fill_scores, stored_scores
from tidemark.operators.scoring import lexicon_scorer, score_mentions

SCHEMA = "i int, text string, projects_mentions array<struct<project:string,mentions:int>>"


def scores(df, scorer):
    found = score_mentions(df, scorer).select("i", "projects_mentions_polarity").collect()
    return {i: None if s is None else [tuple(x) for x in s] for i, s in found}


def test_scorer_contract(spark):
    data = [
        (1, "no mentions here", None),
        (2, "nothing back", [("a", 1)]),
        (3, "twice", [("a", 1), ("b", 2), ("a", 3)]),
        (4, "unknown", [("a", 1)]),
    ]
    df = spark.createDataFrame(data, SCHEMA).coalesce(1)

    def scorer(batch):
        replies = {
            "nothing back": lambda ps: [],
            "twice": lambda ps: [(p, "s", 2.5) for p in ps] + [("a", "again", -0.5)],
            "unknown": lambda ps: [("z", "s", 0.0)],
        }
        return [replies[text](projects) for projects, text in batch]

    assert scores(df, scorer) == {
        1: None,
        2: None,
        3: [("a", "s", 2.5), ("b", "s", 2.5), ("a", "again", -0.5)],
        4: [("z", "s", 0.0)],
    }


def test_scorer_never_sees_rows_without_mentions(spark):
    df = spark.createDataFrame([(i, f"t{i}", [("a", 1)] if i % 3 == 0 else None) for i in range(10)], SCHEMA)

    def scorer(batch):
        assert all(int(text[1:]) % 3 == 0 for _, text in batch)
        return [[("a", text, 0.0)] for _, text in batch]

    assert {i for i, s in scores(df, scorer).items() if s} == {0, 3, 6, 9}


def test_lexicon():
    (good,), (bad,), (none,) = lexicon_scorer()(
        [(["a"], "a is great. Really fast, slow once"), (["a"], "awful"), (["a"], "")]
    )
    assert good == ("a", "a is great.", 0.333)
    assert bad[2] == -1.0
    assert none == ("a", "", 0.0)


def counting_scorer(calls):
    def score(batch):
        calls.add(len(batch))
        return [[(p, text[:3], float(len(text))) for p in projects] for projects, text in batch]

    return score


def stored(df, path, version):
    found = stored_scores(df, path, version).select("i", "projects_mentions_polarity").collect()
    return {i: None if s is None else [tuple(x) for x in s] for i, s in found}


def test_store_scores_each_content_once(spark, tmp_path):
    path, a, ab = str(tmp_path / "scores"), [("a", 1)], [("a", 1), ("b", 2)]
    data = [(i, "same text", a) for i in range(50)]
    data += [(50, "same text", [("a", 7), ("a", 2)]), (51, "same text", ab), (52, None, a), (53, "", a), (54, "none", None)]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    calls = spark.sparkContext.accumulator(0)
    assert set(stored(df, path, "1").values()) == {None}
    fill_scores(df, counting_scorer(calls), path, "1")
    # How often a project is mentioned is nothing a scorer sees.
    assert calls.value == 3
    found = stored(df, path, "1")
    assert found == {**{i: [("a", "sam", 9.0)] for i in range(51)}, 51: [("a", "sam", 9.0), ("b", "sam", 9.0)],
                     52: [("a", "", 0.0)], 53: [("a", "", 0.0)], 54: None}
    fill_scores(df, counting_scorer(calls), path, "1")
    assert calls.value == 3
    more = df.unionByName(spark.createDataFrame([(60, "new", a)], SCHEMA))
    fill_scores(more, counting_scorer(calls), path, "1")
    assert calls.value == 4
    assert stored(more, path, "1") == {**found, 60: [("a", "new", 3.0)]}
    assert set(stored(df, path, "2").values()) == {None}
    fill_scores(df, counting_scorer(calls), path, "2")
    assert calls.value == 7


def test_store_keeps_contents_without_a_score(spark, tmp_path):
    path = str(tmp_path / "scores")
    df = spark.createDataFrame([(1, "x", [("a", 1)]), (2, "y", None)], SCHEMA)
    calls = spark.sparkContext.accumulator(0)

    def nothing(batch):
        calls.add(len(batch))
        return [[] for _ in batch]

    for _ in range(2):
        fill_scores(df, nothing, path, "1")
        assert stored(df, path, "1") == {1: None, 2: None}
    assert calls.value == 1


def test_failed_scorer_leaves_no_rows(spark, tmp_path):
    path = str(tmp_path / "scores")
    df = spark.createDataFrame([(i, f"t{i}", [("a", 1)]) for i in range(20)], SCHEMA).repartition(4)

    def failing(batch):
        if any(text == "t7" for _, text in batch):
            raise ValueError("no reply")
        return [[("a", text, 1.0)] for _, text in batch]

    with pytest.raises(Exception, match="no reply"):
        fill_scores(df, failing, path, "1")
    assert set(stored(df, path, "1").values()) == {None}
    fill_scores(df.limit(0), failing, path, "1")
    calls = spark.sparkContext.accumulator(0)
    fill_scores(df, counting_scorer(calls), path, "1")
    assert calls.value == 20
