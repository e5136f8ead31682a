"""Bit planes: exact round trips, and the files against the library."""

from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import EDGES
from tidemark.llm import kept, tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=70))
def test_planes_round_trip(ids):
    ids = np.array(ids, np.uint32)
    planes = tokens.to_planes(ids)
    assert len(planes) in (16, 32)
    assert (tokens.from_planes(planes, len(ids)) == ids).all()


@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-(1 << 62), 1 << 62)), st.lists(st.integers(0, 70_000), min_size=1, max_size=9)), max_size=9), st.integers(1, 11))
def test_file_round_trip(docs, chunk):
    sink = io.BytesIO()
    writer = tokens.Writer(sink, chunk)
    for doc, ids in docs:
        writer.add(np.array(ids, np.uint32), np.array([len(ids)]), [doc])
    assert writer.close() == len(docs)
    reader = tokens.Reader(sink)
    assert reader.doc_ids.tolist() == [d for d, _ in docs]
    want, at = [], 0
    for _, ids in docs:
        want.append((at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert list(reader.documents()) == want
    flat = [i for _, ids in docs for i in ids]
    for k in range(len(reader.chunks)):
        assert reader.chunk(k).tolist() == flat[k * chunk : (k + 1) * chunk]


def test_cut_off_file_is_refused():
    sink = io.BytesIO()
    tokens.Writer(sink).close()
    with pytest.raises(ValueError):
        tokens.Reader(io.BytesIO(sink.getvalue()[:-1]))


def test_words_beyond_the_kept_ones(monkeypatch):
    monkeypatch.setattr(kept, "KEPT_WORDS", 2)
    library = Tokenizer.from_file(FILE)
    encoder = kept.WordEncoder(tokens._library(library.to_str()))
    for texts in ([["a", " b", " c"]], [[" d", " e", "a", " f"], []], [[" e", " g", "zz"]]):
        want = [[i for w in t for i in library.encode(w).ids] for t in texts]
        for low in (0, 1):
            # Also of a part of a column.
            ids, ends = encoder.encode(pa.array([["zz"], *texts] if low else texts, pa.list_(pa.string()))[low:])
            assert ids.tolist() == sum(want, []) and ends.tolist() == np.cumsum([len(x) for x in want]).tolist()


def plain(rows):
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    order = lambda x: ("" if x is None else "x", x or "")
    out, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, order(r[1]))):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, tokens.END_ID], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def key(row):
    return tuple((x is not None, x or 0) for x in row)


@pytest.mark.parametrize("partitions", [None, 5])
def test_equals_library(docs, texts, partitions):
    got = tokens.token_table(docs, FILE, public_tokenizers.PATTERN, partitions=partitions).collect()
    assert sorted(map(tuple, got)) == plain(texts.items())


def test_edge_rows(edges, nothing, tmp_path):
    got = tokens.token_table(edges, FILE, public_tokenizers.PATTERN, folder=str(tmp_path / "new"), partitions=3).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain([r[:2] for r in EDGES]), key=key)
    assert list((tmp_path / "new").glob("*.planes"))
    assert tokens.token_table(nothing, FILE, public_tokenizers.PATTERN).collect() == []


def test_added_tokens_in_texts(spark):
    texts = ["a  <|endoftext|> b", "<|endoftext|><|endoftext|>", "it's<|endoftext|>\n\nnew \n", "<|endoftext| >", "  x", "y" * 20_000 + "<|endoftext|>" + " z\n" * 20_000]
    library = Tokenizer.from_file(FILE)
    want, at = [], 0
    for doc, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, tokens.END_ID], "<u4")
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, tokens.token_table(rows, FILE, public_tokenizers.PATTERN).collect())) == want


def test_a_worker_builds_an_encoder_once(spark):
    """Six tasks, two vocabularies of one size: each worker builds each once."""

    def run(batches):
        import os

        for batch in batches:
            for i in batch.column(0).to_pylist():
                built = []
                for name in ("a", "b"):
                    make = lambda name=name: built.append(name) or (lambda words: [[ord(name)] for _ in words])
                    ids, _ = kept.word_encoder(kept.content_key("test", name), make).encode(pa.array([["word"]]))
                    assert ids.tolist() == [ord(name)]
                yield pa.RecordBatch.from_pydict({"i": [i], "worker": [os.getpid()], "built": [len(built)]})

    rows = spark.range(0, 60, 1, 30).mapInArrow(run, "i long, worker long, built long").collect()
    workers = {r.worker for r in rows}
    assert len(rows) == 60 and len(workers) < 30
    assert sum(r.built for r in rows) <= 2 * len(workers)
