"""Token ids in a binary format of bit planes.

A file holds documents in ascending order of doc_id, and is made of

    magic    8 bytes
    chunks   blocks of ids: 16 or 32 planes; plane p holds bit p of every id of
             the chunk, eight to a byte, compressed by itself with zstandard
    table    for each document the number of ids up to its end in this file,
             its doc_id and whether that is NULL (u64 each), as byte planes
    index    for each chunk its place in the file, its ids, its planes, and the
             length of each plane (u64 each), as byte planes
    footer   places of table and index, numbers of documents, of ids and of
             entries in the index (u64 each), magic

so that any chunk can be read by itself. Numbers are little-endian.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.llm.common import saved
from tidemark.llm.kept import content_key, slices, word_encoder

MAGIC = b"BITPLANE"
CHUNK = 1 << 16
LEVEL = 3
END_ID = 2
_FOOTER = "<QQQQQ8s"


def to_planes(ids: np.ndarray) -> list[bytes]:
    """Bit planes of a block of ids, low bit first: 16 if they fit, or 32."""
    width = 16 if not len(ids) or int(ids.max()) < 1 << 16 else 32
    kind = "<u2" if width == 16 else "<u4"
    bits = np.unpackbits(ids.astype(kind).view(np.uint8).reshape(len(ids), width // 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return [row.tobytes() for row in packed]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block of n."""
    rows = np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), -1)
    bits = np.unpackbits(rows, axis=1, count=n, bitorder="little")
    raw = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return raw.view("<u2" if len(planes) == 16 else "<u4").ravel().astype("<u4")


def _byte_planes(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), LEVEL)


def _from_byte_planes(packed: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed, max_output_size=8 * n) if n else b"", np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view("<u8").ravel()


class Writer:
    """Writes one file, a chunk at a time."""

    def __init__(self, sink, chunk: int = CHUNK, level: int = LEVEL):
        self.sink, self.chunk = sink, chunk
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.at = 0
        self.table: list[np.ndarray] = []
        self.index: list[int] = []
        self._put(MAGIC)

    def _put(self, raw: bytes) -> None:
        self.sink.write(raw)
        self.at += len(raw)

    def add(self, ids: np.ndarray, lengths: np.ndarray, doc_ids: list[int | None]) -> None:
        """The ids of some documents, end ids included."""
        ends = self.n_ids + np.cumsum(lengths, dtype=np.uint64)
        known = np.array([x or 0 for x in doc_ids], np.int64).view(np.uint64)
        self.table.append(np.column_stack([ends, known, [x is None for x in doc_ids]]).astype(np.uint64))
        self.waiting.append(ids)
        self.n_ids += len(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.chunk:
            ready = np.concatenate(self.waiting)
            whole = len(ready) // self.chunk * self.chunk
            for start in range(0, whole, self.chunk):
                self._chunk(ready[start : start + self.chunk])
            self.waiting, self.n_waiting = [ready[whole:]], len(ready) - whole

    def _chunk(self, ids: np.ndarray) -> None:
        packed = [self.zstd.compress(plane) for plane in to_planes(ids)]
        self.index += [self.at, len(ids), len(packed), *map(len, packed)]
        self._put(b"".join(packed))

    def close(self) -> int:
        """Number of documents."""
        rest = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        if len(rest):
            self._chunk(rest)
        table = np.concatenate(self.table) if self.table else np.zeros((0, 3), np.uint64)
        at_table = self.at
        self._put(_byte_planes(table.T.ravel()))
        at_index = self.at
        self._put(_byte_planes(np.array(self.index, np.uint64)))
        self._put(struct.pack(_FOOTER, at_table, at_index, len(table), self.n_ids, len(self.index), MAGIC))
        return len(table)


class Reader:
    """Reads one file; ``source`` can seek."""

    def __init__(self, source):
        self.source = source
        self.zstd = zstandard.ZstdDecompressor()
        source.seek(0, 2)
        size = source.tell()
        footer = self._read(size - struct.calcsize(_FOOTER), struct.calcsize(_FOOTER))
        at_table, at_index, n_docs, self.n_ids, entries, magic = struct.unpack(_FOOTER, footer)
        if magic != MAGIC or self._read(0, 8) != MAGIC:
            raise ValueError("not a file of bit planes, or cut off")
        flat = _from_byte_planes(self._read(at_index, size - struct.calcsize(_FOOTER) - at_index), entries).astype(np.int64)
        self.chunks = []
        at = 0
        while at < len(flat):
            place, n, planes = flat[at : at + 3]
            self.chunks.append((int(place), int(n), flat[at + 3 : at + 3 + planes]))
            at += 3 + planes
        self.ends, doc_ids, unknown = _from_byte_planes(self._read(at_table, at_index - at_table), 3 * n_docs).reshape(3, -1)
        self.doc_ids = np.ma.array(doc_ids.view(np.int64), mask=unknown.astype(bool))

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def chunk(self, number: int) -> np.ndarray:
        place, n, lengths = self.chunks[number]
        packed = self._read(place, int(lengths.sum()))
        cuts = np.concatenate([[0], np.cumsum(lengths)])
        return from_planes([self.zstd.decompress(packed[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], n)

    def documents(self) -> Iterator[tuple[int, int, int]]:
        """(start in this file, number of ids, crc32 of the ids) of each
        document, with one chunk in memory."""
        done = crc = doc = begin = 0
        for number in range(len(self.chunks)):
            ids = self.chunk(number)
            at = 0
            while at < len(ids):
                to = min(len(ids), int(self.ends[doc]) - done)
                crc = zlib.crc32(ids[at:to].tobytes(), crc)
                if done + to == self.ends[doc]:
                    yield begin, int(self.ends[doc]) - begin, crc
                    begin, crc, doc = int(self.ends[doc]), 0, doc + 1
                at = to
            done += len(ids)


def _library(vocabulary: str):
    """Encodes words one by one with the tokenizers library."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(vocabulary)
    return lambda words: [x.ids for x in library.encode_batch_fast(words, add_special_tokens=False)]


def _added(vocabulary: str) -> list[str]:
    """The added tokens of a tokenizer file, which texts are cut at first."""
    added = json.loads(vocabulary).get("added_tokens") or []
    for token in added:
        if any(token.get(x) for x in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {token['content']!r} takes more than its own characters")
    # The first of those that begin at a place counts, the longest by this order.
    return sorted((token["content"] for token in added), key=len, reverse=True)


def _split(text: Column, pattern: str, added: list[str]) -> Column:
    """The words of a text, with the added tokens as words of their own."""
    find = lambda part: F.regexp_extract_all(part, F.lit("(?U)" + pattern), F.lit(0))
    plain = find(text)
    if added:
        token = "|".join("".join(f"\\x{{{ord(c):x}}}" for c in one) for one in added)
        parts = F.regexp_extract_all(text, F.lit(rf"(?s)(?:{token})|.+?(?=(?:{token})|\z)"), F.lit(0))
        cut = F.flatten(F.transform(parts, lambda part: F.when(part.isin(added), F.array(part)).otherwise(find(part))))
        plain = F.when(text.rlike(token), cut).otherwise(plain)
    return F.coalesce(plain, F.array().cast("array<string>"))


def write_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    folder: str,
    pattern: str,
    end_id: int = END_ID,
    partitions: int | None = None,
) -> DataFrame:
    """Writes the files and returns their manifest: (file, path, n_docs,
    n_ids), a row for each file; file numbers ascend with doc_id.

    Documents are dealt to files by ranges of (doc_id, text), NULL ids first,
    NULL texts before others, so that equal rows are written alike whatever
    order they come in. A task writes its file under a name of its own, and the
    manifest names those of the tasks that counted: one that was lost or ran
    twice leaves a file that nobody reads. ``folder`` is any store that
    pyarrow's file systems reach. No special tokens are added, but those
    that a text holds get their own ids, as the library does by default; NULL is
    as empty, and ``end_id`` follows every document.
    ``pattern`` is what the tokenizer splits texts by: Spark does that, and the
    library encodes the distinct words.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        vocabulary = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    key = content_key("library", vocabulary)
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    # Spark samples the ranges' keys: beginnings of texts will do.
    coarse = [order[0], F.substring("text", 1, 16).asc_nulls_first()]
    ranged = docs.select("doc_id", "text")
    ranged = ranged.repartitionByRange(partitions, *coarse) if partitions else ranged.repartitionByRange(*coarse)
    ranged = ranged.sortWithinPartitions(*order)

    words = _split(F.col("text"), pattern, _added(vocabulary))
    split = ranged.select("doc_id", words.alias("words"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import uuid

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        writer = None
        number = TaskContext.get().partitionId()
        name = f"{folder}/part-{number:06d}-{uuid.uuid4().hex}.planes"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = word_encoder(key, lambda: _library(shared.value))
                store, path = fs.FileSystem.from_uri(name)
                sink = store.open_output_stream(path)
                writer = Writer(sink)
            doc_ids, lists = batch.column(0).to_pylist(), batch.column(1)
            for at, to in slices(lists.offsets.to_numpy()):
                ids, ends = encoder.encode(lists[at:to])
                lengths = np.diff(ends, prepend=0) + 1
                writer.add(np.insert(ids, ends, np.uint32(end_id)), lengths, doc_ids[at:to])
        if writer is not None:
            n_docs = writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [number], "path": [name], "n_docs": [n_docs], "n_ids": [writer.n_ids]})

    return saved(split.mapInArrow(write, "file long, path string, n_docs long, n_ids long"), "manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files:
    ``start`` counts the ids of all documents before it. A task reads a file, a
    chunk at a time."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file.
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_file(path) as source:
                    reader = Reader(source)
                    begin, size, crc = np.array(list(reader.documents()), np.int64).T
                doc_ids = pa.array(reader.doc_ids.data, pa.int64(), mask=np.ma.getmaskarray(reader.doc_ids))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(begin + start), pa.array(size), pa.array(crc)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # A number that adaptive execution keeps: files are few rows and much work.
    return placed.repartition(max(manifest.count(), 1), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(
    docs: DataFrame, tokenizer_file: str, pattern: str, folder: str | None = None, **options
) -> DataFrame:
    """doc_id (a long), start, n_tokens and ids_crc32 of every document, as read
    back from the files that ``write_tokens`` has just written to ``folder``, by
    default a new one in the shared scratch folder. An empty table writes none.
    """
    folder = folder or storage.scratch(docs.sparkSession, "tokens")
    if ":/" not in folder:
        folder = f"file://{folder}"
    storage.make_dir(docs.sparkSession, folder)
    return read_documents(write_tokens(docs, tokenizer_file, folder, pattern, **options))
