"""Fingerprints of documents from improbable features, in Bloom filters."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved

# Bytes of a feature, and features among which the rarest counts.
WINDOW = 64
NEIGHBOURS = 64
# How often a feature has to be the rarest one to be selected.
POPULAR = 16
# Texts of fewer bytes have too few features to rank: all their runs of 16 count.
SHORT = 256
SHORT_WINDOW = 16
# Classes of entropy; below the first used one, features say nothing.
CLASSES = 1001
LOWEST = 100
# Bits of a filter, bits that a feature sets, features in a filter.
BITS = 2048
HASHES = 5
FULL = 160
_BASE = 0x9E3779B97F4A7C15
# Bytes that are worked on at a time; a longer text is worked on by itself.
_RUN = 1 << 20
_NEVER = CLASSES


def _gain() -> np.ndarray:
    """What the (c+1)-th equal byte adds to the sum of c log2 c, as integers."""
    c = np.arange(1, WINDOW + 2, dtype=np.float64)
    total = np.rint(c * np.log2(c) * 65536).astype(np.int64)
    return np.concatenate([[0], np.diff(total)])


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The class of the entropy of every 64 neighbouring bytes.

    With c of each byte value in a window, its entropy is 6 bits less the sum
    of c log2 c / 64. That sum is what all bytes up to the window's end have
    added, given the equal ones in the 63 before them, less what the bytes
    before its start took away, given the equal ones in the 63 after them.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    order = np.argsort(data, kind="stable")
    key = data[order].astype(np.int64) * (n + 2 * WINDOW) + order
    rank = np.arange(n)
    near = np.empty(n, np.int64)
    gain = _gain()
    near[order] = gain[rank - np.searchsorted(key, key - (WINDOW - 1))]
    added = np.cumsum(near)
    near[order] = gain[np.searchsorted(key, key + (WINDOW - 1), "right") - rank - 1]
    taken = np.concatenate([[0], np.cumsum(near)[: n - WINDOW]])
    total = added[WINDOW - 1 :] - taken
    # 6 bits at most: 6 * 64 * 65536 is all of it.
    return ((CLASSES - 1) * (384 * 65536 - total)) // (384 * 65536)


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums and powers from which the hash of any window follows."""
    n = len(data)
    powers = np.cumprod(np.full(n, _BASE, np.uint64))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each class of entropy, 0 for the one with the fewest windows of
    all documents; ``_NEVER`` for those too low to say anything."""
    ranks = np.empty(CLASSES, np.int64)
    ranks[np.lexsort((np.arange(CLASSES), counts))] = np.arange(CLASSES)
    ranks[:LOWEST] = _NEVER
    return ranks


def select(data: np.ndarray, starts: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the selected features of texts that lie end to end.

    Of every 64 neighbouring features of a text, or of all if it has fewer, the
    first of the rarest gets a point; features with 16 points are selected. If
    no feature gets so many, it is the one with the most, if any says something.
    A text of fewer than 256 bytes has all its runs of 16 bytes, or itself.
    """
    ends = np.append(starts[1:], len(data))
    lengths = ends - starts
    owner = np.repeat(np.arange(len(starts)), lengths)
    picked_text: list[np.ndarray] = []
    picked_hash: list[np.ndarray] = []
    n = len(data) - WINDOW + 1
    sums = _window_hashes(data)
    if n > 0:
        whole = owner[:n] == owner[WINDOW - 1 :]
        rank = np.where(whole, ranks[entropy_classes(data)], _NEVER)
        key = (rank << 40) | np.arange(n)
        points = np.zeros(n, np.int64)
        if n >= NEIGHBOURS:
            least, width = key, 1
            while width < NEIGHBOURS:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            span = NEIGHBOURS + WINDOW - 2
            inside = owner[: len(least)] == owner[span : span + len(least)]
            best = least[inside]
            best = best[best >> 40 < _NEVER] & ((1 << 40) - 1)
            points += np.bincount(best, minlength=n)
        chosen = points >= POPULAR
        has = np.zeros(len(starts), bool)
        has[owner[:n][chosen]] = True
        long = lengths >= SHORT
        chosen &= long[owner[:n]]
        for t in np.flatnonzero(~has & long):
            part = slice(starts[t], ends[t] - WINDOW + 1)
            top = np.argmax(points[part]) if points[part].any() else np.argmin(key[part])
            if rank[part][top] < _NEVER:
                chosen[starts[t] + top] = True
        at = np.flatnonzero(chosen)
        picked_text.append(owner[at])
        # Hashes that do not depend on the place in the buffer.
        inverse = np.uint64(pow(_BASE, -1, 1 << 64))
        back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, inverse, np.uint64)]))
        picked_hash.append((sums[at + WINDOW] - sums[at]) * back[at])
    for t in np.flatnonzero((lengths > 0) & (lengths < SHORT)):
        size = min(int(lengths[t]), SHORT_WINDOW)
        runs = np.lib.stride_tricks.sliding_window_view(data[starts[t] : ends[t]], size)
        weights = np.cumprod(np.full(size, _BASE, np.uint64))
        picked_text.append(np.full(len(runs), t))
        picked_hash.append(((runs.astype(np.uint64) + np.uint64(1)) * weights).sum(axis=1, dtype=np.uint64) + np.uint64(size))
    if not picked_text:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text, value = np.concatenate(picked_text), _mix(np.concatenate(picked_hash))
    # Each feature of a text once, where it comes first.
    order = np.lexsort((np.arange(len(text)), value, text))
    first = np.ones(len(order), bool)
    first[1:] = (text[order][1:] != text[order][:-1]) | (value[order][1:] != value[order][:-1])
    keep = np.sort(order[first])
    keep = keep[np.argsort(text[keep], kind="stable")]
    return text[keep], value[keep]


def filters(text: np.ndarray, value: np.ndarray, n_texts: int) -> list[np.ndarray]:
    """The chained filters of each text, 160 features in each, rows of bytes."""
    counts = np.bincount(text, minlength=n_texts)
    before = np.concatenate([[0], np.cumsum(counts)])
    chain = (np.arange(len(text)) - before[text]) // FULL
    per_text = -(-counts // FULL)
    offset = np.concatenate([[0], np.cumsum(per_text)])
    bits = np.zeros((int(offset[-1]), BITS), bool)
    row = offset[text] + chain
    for k in range(HASHES):
        bits[row, (value >> np.uint64(11 * k)).astype(np.int64) % BITS] = True
    packed = np.packbits(bits, axis=1, bitorder="little")
    return [packed[a:b] for a, b in zip(offset[:-1], offset[1:], strict=True)]


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """How much of the smaller chain is in the other one, 0 to 1: for each of
    its filters the best normalised overlap, weighed by its set bits. The
    overlap is 0 at what two such filters share by chance, and 1 if all bits of
    the sparser one are shared. Nothing is like nothing."""
    if not len(left) or not len(right):
        return float(len(left) == len(right))
    if len(left) > len(right) or (len(left) == len(right) and left.tobytes() > right.tobytes()):
        left, right = right, left
    a, b = left.view(np.uint64), right.view(np.uint64)
    in_a, in_b = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for row, size in zip(a, in_a, strict=True):
        shared = np.bitwise_count(b & row).sum(1, dtype=np.int64)
        chance = size * in_b / BITS
        most = np.minimum(size, in_b)
        score = np.where(shared == most, 1.0, (shared - chance) / np.maximum(most - chance, 1e-9))
        total += size * min(1.0, max(0.0, float(score.max())))
    return float(total / in_a.sum())


def digest(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def chains(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The filters of each text, worked on some at a time."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        to, size = at + 1, len(texts[at])
        while to < len(texts) and size + len(texts[to]) <= _RUN:
            size += len(texts[to])
            to += 1
        group = texts[at:to]
        data = np.frombuffer(b"".join(group), np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in group])[:-1]]).astype(np.int64)
        out += filters(*select(data, starts, ranks), len(group))
        at = to
    return out


def class_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all documents are in each class of entropy. Each
    task sends one count for each class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CLASSES, np.int64)
        for batch in batches:
            texts = [t.encode() for t in batch.column(0).to_pylist() if t]
            at = 0
            while at < len(texts):
                to, size = at + 1, len(texts[at])
                while to < len(texts) and size + len(texts[to]) <= _RUN:
                    size += len(texts[to])
                    to += 1
                data = np.frombuffer(b"".join(texts[at:to]), np.uint8)
                owner = np.repeat(np.arange(to - at), [len(t) for t in texts[at:to]])
                inside = owner[: len(data) - WINDOW + 1] == owner[WINDOW - 1 :]
                if len(data) >= WINDOW:
                    seen += np.bincount(entropy_classes(data)[inside], minlength=CLASSES)
                at = to
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(seen)], names=["cell", "n"])

    counted = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(CLASSES, np.int64)
    for cell, n in counted.collect():
        out[cell] = n
    return out


def _edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


_COLUMNS = (
    "doc_id {}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, part int, first boolean, last boolean, text string, chain binary"
)


def _result(doc_ids, texts, prints, edited, edited_prints, following) -> list:
    """Columns of documents whose next one is known."""
    return [
        doc_ids,
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
        pa.array([digest(c) for c in prints], pa.string()),
        pa.array([digest(c) for c in edited_prints], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(prints, edited_prints, strict=True)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(prints, following, strict=True)], pa.float64()),
    ]


def fingerprinted(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next for every document.

    A fingerprint is the document's chain of Bloom filters in base64. NULL texts
    are as empty ones, whose fingerprint is the empty string. ``edited`` is the
    text with its last quarter (in code points, rounded down) replaced by as
    much of the start of the next document, or all of that; the next one is by
    (doc_id, text), NULL first, and after the last comes the first. Equal rows
    are rows of their own, next to each other.

    Which classes of entropy are rare is counted over all documents. Then the
    rows are dealt to ranges and sorted, so that a task has next to each other
    what is next to each other; the last row of a task waits for the first one
    of the next task, and these few are joined by the task's number.
    """
    ranks = rarity(class_counts(docs))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = _COLUMNS.format(id_type)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ranks, part = shared.value, TaskContext.get().partitionId()
        names = [c.split()[0] for c in schema.split(", ")]
        waiting = None  # id, text and chain of the last row so far
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t or "" for t in batch.column(1).to_pylist()]
            prints = chains([t.encode() for t in texts], ranks)
            ids = batch.column(0)
            if waiting:
                ids = pa.concat_arrays([waiting[0], ids])
                texts, prints = [waiting[1], *texts], [waiting[2], *prints]
            waiting = ids[-1:], texts[-1], prints[-1]
            n = len(texts) - 1
            if not n:
                continue
            edited = [_edited(a, b).encode() for a, b in zip(texts[:-1], texts[1:], strict=True)]
            columns = _result(ids[:-1], texts[:-1], prints[:-1], edited, chains(edited, ranks), prints[1:])
            start = [first] + [False] * (n - 1)
            columns += [
                pa.array([part] * n, pa.int32()),
                pa.array(start),
                pa.array([False] * n),
                pa.array([texts[0] if s else None for s in start], pa.string()),
                pa.array([prints[0].tobytes() if s else None for s in start], pa.binary()),
            ]
            first = False
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if waiting:
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = [waiting[0], *[pa.nulls(1, kind) for kind in kinds], pa.array([part], pa.int32())]
            columns += [pa.array([first]), pa.array([True]), pa.array([waiting[1]]), pa.array([waiting[2].tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    # Spark samples the ranges' keys: beginnings of texts will do.
    coarse = [order[0], F.substring("text", 1, 16).asc_nulls_first()]
    rows = docs.select("doc_id", "text")
    rows = rows.repartitionByRange(partitions, *coarse) if partitions else rows.repartitionByRange(*coarse)
    done = saved(rows.sortWithinPartitions(*order).mapInArrow(work, schema), "prints")

    # One row for each task that had any.
    along = Window.orderBy("part")
    parts = done.where("first").select("part").distinct()
    following = parts.select(
        "part",
        F.coalesce(F.lead("part").over(along), F.min("part").over(Window.partitionBy())).alias("after"),
    )
    heads = done.where("first").select(F.col("part").alias("after"), F.col("text").alias("next"), F.col("chain").alias("next_chain"))
    open_rows = done.where("last").select("doc_id", "text", "chain", "part").join(following, "part").join(heads, "after")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = lambda raw: np.frombuffer(raw, np.uint8).reshape(-1, BITS // 8)
        for batch in batches:
            texts, nexts = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            prints, after = ([chain(x) for x in batch.column(k).to_pylist()] for k in (2, 4))
            edited = [_edited(a, b).encode() for a, b in zip(texts, nexts, strict=True)]
            columns = _result(batch.column(0), texts, prints, edited, chains(edited, shared.value), after)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ended = open_rows.select("doc_id", "text", "chain", "next", "next_chain").mapInArrow(
        finish, schema[: schema.index(", part int")]
    )
    return done.where("NOT last").select(*names).unionByName(ended)
