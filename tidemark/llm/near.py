"""Near-duplicate documents by improved consistent weighted sampling."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, in_parts, linked_groups, saved

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 4
# Candidates are found for so many parts of the bands, one after another.
PARTS = 4
# Samples of documents that have candidates. Pairs of which fewer agree than for
# a similar pair at four standard deviations are not compared: a chance of about
# 3 in 100,000.
FINE = 512
# Cells of a table of weights by the first bits of a hash (``log_weights``).
FEATURES = 1 << 16
# Variates of a sample; shingles choose theirs by hash.
_POOL = 1 << 16
# Weights are sampled on a grid of this step in their logarithm.
_STEP = 0.1
_CHUNK = 1 << 15
# Words that are worked on at a time; a longer text is worked on by itself.
_WORDS = 1 << 20
# Passes over the texts that count their shingles, and characters of texts whose
# shingles a part of a pass counts, some 700,000.
PASSES = 2
_PART_CHARS = 4 << 20
_ODD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _by_text(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The order by text, then value. A sort of whole numbers and one of few
    small ones are faster than ``lexsort``."""
    if not len(text) or text.max() >= 1 << 16:
        return np.lexsort((value, text))
    order = np.argsort(value)
    return order[np.argsort(text[order].astype(np.uint16), kind="stable")]


@dataclass
class Shingled:
    """Distinct shingles of several texts, text by text, in order of hash."""

    text: np.ndarray  # of each shingle
    hash: np.ndarray
    count: np.ndarray


def shingle(
    hashes: np.ndarray, offsets: np.ndarray, size: int = SHINGLE, wanted: Callable[[np.ndarray], np.ndarray] | None = None
) -> Shingled:
    """Runs of ``size`` words; a text with fewer words, but one at least, is one
    shingle. Words come as hashes. ``wanted`` tells from the hashes of shingles
    which to return."""
    w = hashes.view(np.uint64) if hashes.dtype == np.int64 else hashes
    lengths = np.diff(offsets)
    total = len(w)
    key = np.zeros(max(total - size + 1, 0), np.uint64)
    for j in range(size):
        key = _mix(key * np.uint64(_ODD) + w[j : j + len(key)] + np.uint64(1))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = owner[: len(key)] == owner[size - 1 :] if len(key) else np.zeros(0, bool)
    text, value = owner[: len(key)][inside], key[inside]
    for n in range(1, size):
        short = np.flatnonzero(lengths == n)
        if len(short):
            one = np.full(len(short), n, np.uint64)
            for j in range(n):
                one = _mix(one * np.uint64(_ODD) + w[offsets[short] + j])
            text, value = np.concatenate([text, short]), np.concatenate([value, one])
    if wanted is not None:
        fit = wanted(value)
        text, value = text[fit], value[fit]
    order = _by_text(text, value)
    text, value = text[order], value[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(first)
    return Shingled(text[at], value[at], np.diff(np.append(at, len(text))))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def _slices(*offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows that are worked on together."""
    total = np.sum(offsets, axis=0)
    at, n = 0, len(total) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, total[at] + _WORDS, "right")) - 1)
        yield at, min(to, n)
        at = to


def _part(values: np.ndarray, offsets: np.ndarray, at: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    return values[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]


def _hashed(text: Column) -> Column:
    """The words of a text as hashes; none for NULL."""
    # Cutting at white space is faster than looking for words.
    split = F.array_remove(F.split(text, r"[\x20\x09-\x0D]"), "")
    return F.coalesce(F.transform(split, lambda w: F.xxhash64(w)), F.array().cast("array<long>"))


def hashed_words(docs: DataFrame, *names: str) -> DataFrame:
    return docs.select(*names, _hashed(F.col("text")).alias("words"))


def repeated_shingles(classes: DataFrame, size: int = SHINGLE, parts: int = 64) -> DataFrame:
    """(id, hashes, counts): for each different text (id, copies, words) those
    of its shingles that occur in several documents, and in how many. All others
    occur in one.

    Counts are by 64-bit hash. Hashes are dealt out to ``parts``; of some texts
    at a time all that a part gets is one row, so that a shingle takes little
    more than its hash, and a part tells the texts what it has seen of them. The
    parts are worked on in several passes, which read the texts again: a pass'
    shuffle is gone when the next one begins."""

    def send(number: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def dealt(hashes: np.ndarray) -> np.ndarray:
            return ((hashes >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, copies = (batch.column(k).to_numpy() for k in (0, 1))
                values, offsets = _flat(batch.column(2))
                for at, to in _slices(offsets):
                    found = shingle(*_part(values, offsets, at, to), size, lambda hashes: dealt(hashes) % PASSES == number)
                    part = dealt(found.hash)
                    if len(part):
                        fit = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
                        yield _by_part(part[fit], found.text[fit] + at, found.hash[fit], ids, copies)

        return spread

    sent = "part int, ids array<long>, copies array<long>, runs array<int>, hashes array<long>"
    told = "id long, hashes array<long>, counts array<long>"
    each = classes.select("id", "copies", "words")
    passes = [
        saved(each.mapInArrow(send(k), sent).groupBy("part").applyInArrow(_seen, told), "shingle-counts", release=True)
        for k in range(PASSES)
    ]
    known = reduce(DataFrame.unionByName, passes).groupBy("id").agg(F.collect_list(F.struct("hashes", "counts")).alias("k"))
    out = saved(known.select("id", *[F.flatten(f"k.{c}").alias(c) for c in ("hashes", "counts")]), "shingles", release=True)
    dropped(*passes)
    return out


def _by_part(part: np.ndarray, text: np.ndarray, hashes: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
    """Shingles in order of (part, text) as a row for each part: its texts,
    their copies, how many shingles each has, and these."""
    new = np.append(True, part[1:] != part[:-1])
    run = np.flatnonzero(new | np.append(True, text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    ends = np.append(first, len(part)).astype(np.int32)
    cuts = np.searchsorted(run, ends).astype(np.int32)
    lists = [ids[text[run]], copies[text[run]], np.diff(np.append(run, len(part))).astype(np.int32)]
    columns = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in lists]
    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64))))
    return pa.RecordBatch.from_arrays([pa.array(part[first]), *columns], names=["part", "ids", "copies", "runs", "hashes"])


def _seen(table: pa.Table) -> pa.Table:
    """Of a part's texts the shingles that several documents have."""
    ids, copies, runs, hashes = (
        np.concatenate([_flat(c)[0] for c in table.column(k).chunks]) for k in ("ids", "copies", "runs", "hashes")
    )
    order = np.argsort(hashes)
    ordered = hashes[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    total = np.add.reduceat(np.repeat(copies, runs)[order], first)
    n = np.empty(len(hashes), np.int64)
    n[order] = np.repeat(total, np.diff(np.append(first, len(hashes))))
    several = n > 1
    owner = np.repeat(np.arange(len(ids)), runs)[several]
    start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[: len(owner)])
    ends = pa.array(np.append(start, len(owner)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x[several])) for x in (hashes, n)]
    return pa.Table.from_arrays([pa.array(ids[owner[start]]), *lists], names=["id", "hashes", "counts"])


def idf_weights(
    found: Shingled, hashes: np.ndarray, counts: np.ndarray, offsets: np.ndarray, n_docs: int
) -> np.ndarray:
    """Logarithm of TF * ln(1 + documents / documents that have the shingle).
    Text by text come the shingles of several documents, with their counts."""
    held = np.ones(len(found.hash))
    if len(hashes):
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)).astype(np.uint64)
        known = _mix(hashes.view(np.uint64) + owner * np.uint64(_ODD))
        order = np.argsort(known)
        known, counts = known[order], counts[order]
        key = _mix(found.hash + found.text.astype(np.uint64) * np.uint64(_ODD))
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        held = np.where(known[at] == key, counts[at], 1)
    return np.log(found.count) + np.log(np.log1p(n_docs / held))


def log_weights(found: Shingled, idf: np.ndarray) -> np.ndarray:
    return np.log(found.count) + idf[(found.hash >> np.uint64(48)).astype(np.int64)]


class Sampler:
    """Improved consistent weighted sampling: for a set with weights w, each
    sample takes r, c from Gamma(2, 1) and b from [0, 1) for every element, sets
    t = floor(ln w / r + b), y = exp(r (t - b)), and picks the element with
    the least a = c / (y e^r). Two sets pick the same element and t with a
    probability that equals their weighted Jaccard similarity. Equal (element,
    t) have equal a, so that the least a and its element are the sample."""

    def __init__(self, samples: int, seed: int = 9):
        self.samples = samples
        draw = np.random.default_rng(seed)
        self.r = draw.gamma(2, 1, _POOL)
        self.log_c = np.log(draw.gamma(2, 1, _POOL))
        self.b = draw.random(_POOL)
        self.odd = draw.integers(0, 1 << 62, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.codes: dict[int, np.ndarray] = {}

    def _code(self, level: int) -> np.ndarray:
        """ln a of every variate at a weight, as integers in the same order."""
        if level not in self.codes:
            t = np.floor(level * _STEP / self.r + self.b)
            value = (self.log_c - self.r * (t - self.b) - self.r).astype(np.float32)
            raw = value.view(np.uint32)
            negative = raw >> np.uint32(31) == 1
            self.codes[level] = np.where(negative, ~raw, raw | np.uint32(1 << 31))
        return self.codes[level]

    def sample(self, found: Shingled, log_weight: np.ndarray, n_texts: int) -> np.ndarray:
        """Samples of each text (rows), 0 for a text without shingles."""
        out = np.zeros((n_texts, self.samples), np.uint64)
        if not len(found.text):
            return out
        level = np.rint(log_weight / _STEP).astype(np.int64)
        used, level = np.unique(level, return_inverse=True)
        table = np.concatenate([self._code(int(x)) for x in used]).astype(np.uint64) << np.uint64(32)
        low = found.hash & np.uint64(0xFFFFFFFF)
        base = (level * _POOL).astype(np.uint64)
        starts = np.flatnonzero(np.append(True, found.text[1:] != found.text[:-1]))
        owner = found.text[starts]
        out[owner] = ~np.uint64(0)
        # A chunk at a time stays in the cache; texts may span chunks.
        room = np.empty((2, min(_CHUNK, len(low))), np.uint64)
        for at in range(0, len(low), _CHUNK):
            to = min(at + _CHUNK, len(low))
            first = np.searchsorted(starts, at, "right") - 1
            last = np.searchsorted(starts, to, "left")
            cuts = np.maximum(starts[first:last] - at, 0)
            h, shift, part = found.hash[at:to], base[at:to], low[at:to]
            place, value = room[:, : to - at]
            least = np.empty((self.samples, last - first), np.uint64)
            for k in range(self.samples):
                np.multiply(h, self.odd[k], out=place)
                np.right_shift(place, np.uint64(48), out=place)
                np.add(place, shift, out=place)
                # Without a bound's check the values go straight to their room.
                np.take(table, place.view(np.int64), out=value, mode="clip")
                np.bitwise_or(value, part, out=value)
                np.minimum.reduceat(value, cuts, out=least[k])
            rows = owner[first:last]
            out[rows] = np.minimum(out[rows], least.T)
        return out


def band_keys(samples: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash for each band of ``rows`` samples, with the band's number."""
    bands = samples.shape[1] // rows
    out = np.zeros((len(samples), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(samples), band + 1, np.uint64)
        for j in range(rows):
            key = _mix(key * np.uint64(_ODD) + samples[:, band * rows + j])
        out[:, band] = key
    return out


def _content(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each text's words in order."""
    w = values.view(np.uint64)
    at = np.arange(len(w)) - np.repeat(offsets[:-1], np.diff(offsets))
    mixed = _mix(_mix(w) + at.astype(np.uint64) * np.uint64(_ODD))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return _mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def placed(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, content): the row's key and a hash of its words (NULL if
    it has none)."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = _flat(batch.column(2))
            content = pa.array(_content(values, offsets).view(np.int64), mask=np.diff(offsets) == 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], content], names=["doc_id", "doc", "content"])

    keyed = docs.withColumn("doc", F.xxhash64("doc_id", "text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, doc long, content long"
    return hashed_words(keyed, "doc_id", "doc").mapInArrow(place, schema)


def signatures(known: DataFrame, n_docs: int, size: int, bands: int, rows: int) -> DataFrame:
    """(id, bands): the band keys of different texts (id, words, hashes,
    counts)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(bands * rows)
        for batch in batches:
            for at, to, found, weight in weighed(batch, 1, n_docs, size):
                samples = sampler.sample(found, weight, to - at)
                keys = _lists(band_keys(samples, rows).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:to], keys], names=["id", "bands"])

    return known.select("id", "words", "hashes", "counts").mapInArrow(sign, "id long, bands array<long>")


def weighed(
    batch: pa.RecordBatch, first: int, n_docs: int, size: int
) -> Iterator[tuple[int, int, Shingled, np.ndarray]]:
    """(from, to, shingles, weights) of rows worked on together; the columns
    from ``first`` on are words, hashes, counts."""
    values, offsets = _flat(batch.column(first))
    for at, to in _slices(offsets):
        found = shingle(*_part(values, offsets, at, to), size)
        yield at, to, found, _weights(found, batch, first, at, to, n_docs)


def _weights(found: Shingled, batch: pa.RecordBatch, first: int, at: int, to: int, n_docs: int) -> np.ndarray:
    hashes, cuts = _flat(batch.column(first + 1))
    counts, _ = _flat(batch.column(first + 2))
    low, high = cuts[at], cuts[to]
    return idf_weights(found, hashes[low:high], counts[low:high], cuts[at : to + 1] - low, n_docs)


def _lists(table: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(table).ravel()))


def sketch(samples: np.ndarray) -> np.ndarray:
    """A byte of each sample, eight to a long."""
    return np.ascontiguousarray(_mix(samples).astype(np.uint8)).view(np.int64)


def _spread_down(shift: int):
    return lambda x: x.bitwiseOR(F.shiftrightunsigned(x, shift))


def agreeing(a: str, b: str, samples: int) -> Column:
    """How many samples of two sketches are equal, with those by chance."""
    left = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    for shift in (4, 2, 1):
        left = F.transform(left, _spread_down(shift))
    # The low bit of each byte that differs.
    low = F.lit(0x0101010101010101)
    return F.aggregate(left, F.lit(samples), lambda n, x: n - F.bit_count(x.bitwiseAND(low)))


def weighted_jaccard(left: Shingled, right: Shingled, idf: np.ndarray, n_pairs: int) -> np.ndarray:
    """Sum of lesser over sum of greater weights, pair by pair; TF times IDF."""
    return overlap(left, right, log_weights(left, idf), log_weights(right, idf), n_pairs)


def overlap(left: Shingled, right: Shingled, log_left: np.ndarray, log_right: np.ndarray, n_pairs: int) -> np.ndarray:
    """The same, from the logarithms of the weights."""
    a, b = np.exp(log_left), np.exp(log_right)
    pair = np.concatenate([left.text, right.text])
    value = np.concatenate([left.hash, right.hash])
    weight = np.concatenate([a, b])
    order = np.lexsort((value, pair))
    pair, value, weight = pair[order], value[order], weight[order]
    both = np.flatnonzero((pair[1:] == pair[:-1]) & (value[1:] == value[:-1]))
    shared = np.bincount(pair[both], np.minimum(weight[both], weight[both + 1]), n_pairs)
    total = np.bincount(pair, weight, n_pairs)
    return np.divide(shared, total - shared, out=np.zeros(n_pairs), where=total > shared)


def near_groups(
    docs: DataFrame,
    size: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, doc, lead_doc_id, lead_doc): for every row of the documents the
    row that stands for its group, the one with the smallest (doc_id, key).

    Rows are in one group if links connect them: equal words in equal order, or
    a weighted Jaccard similarity of TF-IDF shingles of at least
    ``similarity``. Shingles are runs of five words between ASCII white space,
    as they are written; a text with fewer words is one shingle. Rows without
    words (NULL, empty, blank) stand for themselves. ``doc`` is a key of
    (doc_id, text), equal for equal rows; NULL ids come last.

    Candidates share one of 16 bands of 4 samples, which pairs at 0.8 do with a
    probability of 0.9998.
    """
    signed = saved(placed(docs), "samples")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "doc")
    classes = saved(
        signed.where(F.col("content").isNotNull())
        .groupBy("content")
        .agg(F.min(order).alias("lead"), F.count("*").alias("copies")),
        "classes",
    )
    n_docs = classes.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    leads = classes.select(F.col("content").alias("id"), "copies", F.col("lead.doc").alias("doc"))
    own = saved(
        docs.select(F.xxhash64("doc_id", "text").alias("doc"), "text").join(leads, "doc").dropDuplicates(["id"]).select("id", "copies", "text"),
        "class-texts",
        release=True,
    )
    chars = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(64, chars // _PART_CHARS)
    repeated = repeated_shingles(hashed_words(own, "id", "copies"), size, parts)
    none = F.array().cast("array<long>")
    listed = [F.coalesce(c, none).alias(c) for c in ("hashes", "counts")]
    known = own.join(repeated, "id", "left").select("id", "text", *listed)
    split = _hashed(F.col("text"))
    banded = saved(signatures(known.withColumn("words", split), n_docs, size, bands, rows), "bands", release=True)
    keys = in_parts(banded, "bands", bands, PARTS)

    def texts(ids: DataFrame) -> DataFrame:
        wanted = known.join(ids, "id", "left_semi").select("id", "text", split.alias("words"), "hashes", "counts")
        return wanted.mapInArrow(
            sketched, "id long, text string, hashes array<long>, counts array<long>, sketch array<long>"
        )

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(FINE, seed=10)
        for batch in batches:
            for at, to, part, weight in weighed(batch, 2, n_docs, size):
                samples = sampler.sample(part, weight, to - at)
                own = [batch.column(k)[at:to] for k in (0, 1, 3, 4)]
                yield pa.RecordBatch.from_arrays(
                    [*own, _lists(sketch(samples))], names=["id", "text", "hashes", "counts", "sketch"]
                )

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"])
            left, right = _flat(batch.column(2)), _flat(batch.column(5))
            for at, to in _slices(left[1], right[1]):
                both = [shingle(*_part(*side, at, to), size) for side in (left, right)]
                weights = [_weights(x, batch, first, at, to, n_docs) for x, first in zip(both, (2, 5), strict=True)]
                # Sums of floats may miss the bound by their last digits.
                ok = overlap(*both, *weights, to - at) >= similarity - 1e-9
                yield pairs[at:to].filter(pa.array(ok))

    def verify(pairs: DataFrame, payload: DataFrame) -> DataFrame:
        hashes = lambda c: _hashed(F.col(c)).alias(c)
        text = payload.select("id", "text", "hashes", "counts")
        both = pairs.join(text.toDF("a", "x", "xh", "xn"), "a").join(text.toDF("b", "y", "yh", "yn"), "b")
        return both.select("a", "b", hashes("x"), "xh", "xn", hashes("y"), "yh", "yn").mapInArrow(hold, "a long, b long")

    least = similarity - 4 * math.sqrt(similarity * (1 - similarity) / FINE)
    plausible = lambda a, b: agreeing(a, b, FINE) >= least * FINE
    roots = saved(linked_groups(keys, texts, verify, plausible, rounds=2), "near-roots")
    rooted = classes.join(roots, classes["content"] == roots["node"], "left").select(
        "content", "lead", F.coalesce("root", "content").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("lead").alias("head"))
    heads = rooted.join(heads, "root").select("content", "head")
    return signed.join(heads, "content", "left").select(
        "doc_id",
        "doc",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("lead_doc_id"),
        F.coalesce("head.doc", "doc").alias("lead_doc"),
    )


def without_near(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; columns
    as they are. Of equal rows one stays, and rows without words all stay."""
    groups = near_groups(docs, **options)
    heads = groups.where(F.col("doc") == F.col("lead_doc")).select(F.col("doc").alias("__doc")).distinct()
    kept = docs.withColumn("__doc", F.xxhash64("doc_id", "text")).join(heads, "__doc")
    nth = F.row_number().over(Window.partitionBy("__doc").orderBy("__doc"))
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return kept.withColumn("__nth", nth).where((F.col("__nth") == 1) | blank).select(*docs.columns)
