"""Byte-level BPE against tiktoken, and exact round trips."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import EDGES
from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES
from tests.conftest import SF

WORDS = ["I'll we've  two   spaces\n\n\nend ", "aaaaaaaaaaaaaaaaaaaaaaaa", "naïve 　 wide   x", "١٢٣ 123 ½", "日本語のテキスト", "\U0001f469‍\U0001f680!?", "\t\t", " ", "it's'S", "\x85\x1c"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_library(spark, docs, ranks, library):
    out = QUERIES["op6_byte_bpe"](spark, SF).collect()
    want = {}
    for r in docs.collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        text = hashlib.sha256((r.text or "").encode()).hexdigest()
        want[r.doc_id] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), text)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out} == want


def test_folded_merges_equal_library(spark, ranks, library):
    rows = spark.createDataFrame(list(enumerate(WORDS)), "doc_id long, text string")
    for size in (3, 100):
        out = bpe.encode_natively(rows, ranks, public_tokenizers.PATTERN, size).collect()
        assert {r.doc_id: list(r.ids) for r in out} == {i: library.encode_ordinary(t) for i, t in enumerate(WORDS)}


def test_native_decoding(spark, ranks):
    rows = bpe.encode(spark.createDataFrame(list(enumerate(WORDS)), "doc_id long, text string"), ranks, public_tokenizers.PATTERN)
    for r in rows.select("*", bpe.decode(F.col("ids"), ranks).alias("bytes")).collect():
        assert bytes(r.bytes) == bytes(r.decoded) == r.text.encode()


@given(st.text(max_size=40))
def test_fold_equals_library(ranks, library, text):
    assert [i for w in regex.findall(public_tokenizers.PATTERN, text) for i in bpe.fold(w.encode(), ranks)] == library.encode_ordinary(text)


def test_edge_rows(edges, nothing, ranks, library):
    out = bpe.with_ids(edges, ranks, public_tokenizers.PATTERN).collect()
    assert len(out) == len(EDGES)
    for r in out:
        assert r.round_trip and list(r.ids) == library.encode_ordinary(r.text or "") and r.n_tokens == len(r.ids)
        assert r.doc == "own doc"
    assert bpe.with_ids(nothing, ranks, public_tokenizers.PATTERN).collect() == []
