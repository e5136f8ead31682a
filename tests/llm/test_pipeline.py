"""The pipeline: each stage on what the one before kept."""

from __future__ import annotations

import re

import corpus_pipeline
import public_tokenizers
import tiktoken

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF
from tests.llm.test_lines import plain, removed, without
from tests.llm.test_near import shingles
from tidemark.llm import bpe, mixing
from tidemark.llm.common import saved


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages(spark, docs):
    columns = docs.columns
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = saved(stage(spark, docs, SF), name)
        kept[name] = docs.collect()
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    first = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    language = {r.doc_id: r.text for r in kept["language_id"]}
    # No document in a language is rejected.
    assert set(language) == {d for d, r in first.items() if any(c.isalpha() for c in r.text or "")}
    lines = {r.doc_id: r.text for r in kept["line_dedup"]}
    gone = removed(saved(corpus_pipeline.language_id(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF), "language"))
    best, _ = plain(language)
    assert gone <= best and len(gone) >= 0.98 * len(best)
    left = without(language, gone)
    assert lines == {d: t for d, t in left.items() if t == language[d] or words(t)}
    assert len(lines) < len(left)
    near = {r.doc_id: r.text for r in kept["near_dedup"]}
    assert near.items() <= lines.items()
    own = [shingles(t) for t in near.values() if words(t)]
    assert len({frozenset(s.items()) for s in own}) == len(own)
    gone = set(lines) - set(near)
    assert all(any(shingles(lines[d]) & shingles(t) for t in near.values()) for d in gone)
    plan = {r.doc_id: r for r in mixing.mix(spark.createDataFrame([(d, t, first[d].source) for d, t in near.items()], "doc_id long, text string, source string"), keep=("doc_id",)).collect()}
    taken = {}
    for r in kept["source_mix"]:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(words(r.text))
    assert taken == {d: r.taken for d, r in plan.items() if r.taken}
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(kept["byte_bpe"]) == len(kept["source_mix"])
    for r in kept["byte_bpe"]:
        assert r.round_trip and list(r.ids) == library.encode_ordinary(r.text)


def test_registered(spark):
    names = queries()
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert (corpus_pipeline.ORACLE_SQL is None) == ("pipeline" not in oracle_sql())
