"""Language identification by prediction by partial matching (PPM)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

ORDER = 3
# The bound on what is learned from: texts of a language, and their bytes.
TRAIN_TEXTS = 1000
TRAIN_BYTES = 1_000_000
UNDETERMINED = "und"
# Mean bits a byte above which a text is in none of the learned languages.
MAX_BITS = 7.0
# Bytes scored at a time; a longer text is scored in several runs.
_RUN = 1 << 20


def training_texts(
    docs: DataFrame,
    eligible: Column,
    train_texts: int = TRAIN_TEXTS,
    train_bytes: int = TRAIN_BYTES,
) -> DataFrame:
    """(lang, text): for each language the first texts in the order of a hash,
    as many as fit the two bounds (one at least).

    Texts longer than a hundredth of ``train_bytes`` come after all others, the
    shorter ones first, so that none of them keeps others out. Where the
    shortest text is beyond the bound by itself, its beginning is taken."""
    rows = docs.where(eligible & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64("text").alias("order"), F.octet_length("text").alias("bytes")
    )
    late = F.when(F.col("bytes") > train_bytes // 100, F.col("bytes")).otherwise(0)
    by_lang = Window.partitionBy("lang").orderBy(late, "order", "text")
    first = rows.withColumn("nth", F.row_number().over(by_lang)).where(F.col("nth") <= train_texts)
    total = F.sum("bytes").over(Window.partitionBy("lang").orderBy("nth"))
    # A character has four bytes at most.
    start = F.when(F.col("bytes") > train_bytes, F.substring("text", 1, train_bytes // 4)).otherwise(F.col("text"))
    return (
        first.withColumn("total", total)
        .where((F.col("total") <= train_bytes) | (F.col("nth") == 1))
        .select("lang", start.alias("text"))
    )


@dataclass(frozen=True)
class Model:
    """Context trees of all languages, frozen: the code length, in bits, of
    every symbol in every context that occurs.

    symbols: number of each byte, 0 for all that never occur.
    state: number of the longest known suffix of the last ``order`` symbols.
    cost: bits by state, symbol and language.
    """

    langs: list[str]
    order: int
    n_symbols: int
    symbols: np.ndarray
    state: np.ndarray
    cost: np.ndarray

    def run_bits(self, buffer: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Total code length of each text of the buffer in each language. The
        symbols before a text are those that never occur."""
        codes = self.symbols[buffer].astype(np.int64)
        at = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
        context = np.zeros(len(codes), np.int64)
        for back in range(self.order, 0, -1):
            shifted = np.zeros(len(codes), np.int64)
            shifted[back:] = codes[:-back]
            shifted[at < back] = 0
            context = context * self.n_symbols + shifted
        cell = self.state[context].astype(np.int64) * self.n_symbols + codes
        bits = self.cost.reshape(-1, len(self.langs))[cell]
        return np.add.reduceat(bits, starts, axis=0, dtype=np.float64)


def learn(texts: dict[str, list[str]], order: int = ORDER) -> Model:
    """Context trees from texts by language.

    In a context that a language has seen, with n symbols of which d are
    different, a symbol seen c times has probability c / (n + d), and d / (n + d)
    is the probability to escape to the context that is one shorter (PPM,
    method C, without exclusion). Below the empty context all bytes are alike.
    A context that a language has not seen costs it nothing to leave.
    """
    langs = sorted(texts)
    data = {
        lang: [np.frombuffer(t.encode(), np.uint8) for t in texts[lang] if t] for lang in langs
    }
    seen = np.unique(np.concatenate([np.zeros(0, np.uint8), *(x for v in data.values() for x in v)]))
    symbols = np.zeros(256, np.uint8 if len(seen) < 255 else np.uint16)
    symbols[seen] = np.arange(1, len(seen) + 1)
    size = len(seen) + 1
    # Symbol 0 is outside of every text: a context that reaches past the start.
    padded = {
        lang: [np.concatenate([np.zeros(order, np.int64), symbols[x].astype(np.int64)]) for x in v]
        for lang, v in data.items()
    }
    bits = np.full((1, size, len(langs)), 8.0, np.float32)
    state = np.zeros(1, np.int32)  # of each context of the order below
    for length in range(order + 1):
        grams: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for lang in langs:
            keys = [_grams(x, order, length, size) for x in padded[lang]]
            grams[lang] = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_counts=True)
        known = np.unique(np.concatenate([np.zeros(0, np.int64), *(g // size for g, _ in grams.values())]))
        # The context without its first symbol is known at the length below.
        below = state[known % size ** (length - 1)] if length else np.zeros(len(known), np.int32)
        fresh = bits[below].copy()
        for k, lang in enumerate(langs):
            found, counts = grams[lang]
            row = np.searchsorted(known, found // size)
            total = np.bincount(row, counts, len(known))
            different = np.bincount(row, minlength=len(known))
            has = total > 0
            escape = np.zeros(len(known), np.float32)
            escape[has] = np.log2((total + different)[has] / different[has])
            lower = fresh[:, :, k] + escape[:, None]
            lower[row, found % size] = np.log2((total + different)[row] / counts)
            fresh[:, :, k] = lower
        table = state[np.arange(size**length) % size ** max(length - 1, 0)] if length else np.zeros(1, np.int32)
        table = table.astype(np.int32)
        table[known] = len(bits) + np.arange(len(known))
        bits, state = np.concatenate([bits, fresh]), table
    return Model(langs, order, size, symbols, state, bits.astype(np.float32))


def _grams(codes: np.ndarray, order: int, length: int, size: int) -> np.ndarray:
    """The context of ``length`` symbols before each symbol, and the symbol."""
    n = len(codes) - order
    key = np.zeros(n, np.int64)
    for back in range(length, -1, -1):
        key = key * size + codes[order - back : order - back + n]
    return key


def score_texts(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bits of every text in every language, and its bytes. Whole texts, a
    bounded number of bytes at a time; a long text is cut into runs that start
    with the last symbols of the one before."""
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    whole = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    total = np.zeros((len(raw), len(model.langs)))
    sizes = np.diff(offsets)
    at = 0
    filled = np.flatnonzero(sizes)
    while at < len(filled):
        first = filled[at]
        if sizes[first] > _RUN:
            for start in range(offsets[first], offsets[first + 1], _RUN):
                lead = max(offsets[first], start - model.order)
                part = whole[lead : min(start + _RUN, offsets[first + 1])]
                bits = model.run_bits(part, np.zeros(1, np.int64))[0]
                if lead < start:
                    bits -= model.run_bits(part[: start - lead], np.zeros(1, np.int64))[0]
                total[first] += bits
            at += 1
            continue
        last = at + 1
        while last < len(filled) and offsets[filled[last] + 1] - offsets[first] <= _RUN:
            last += 1
        rows = filled[at:last]
        part = whole[offsets[first] : offsets[rows[-1] + 1]]
        total[rows] = model.run_bits(part, offsets[rows] - offsets[first])
        at = last
    return total, sizes


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` and ``bits_per_byte``
    (columns of these names are replaced).

    ``lang_pred`` is the language in which the whole text has the shortest
    code, the first by name among equals; ``score`` its posterior probability
    with equal priors; ``bits_per_byte`` the length of that code. A text that
    is NULL, empty or without any letter is ``und`` with score 0 and NULL bits.
    So is every text if no language was learned.
    """
    added = ("lang_pred", "score", "bits_per_byte")
    names = [c for c in docs.columns if c not in added]
    base = docs.select(*names)
    schema = StructType(
        [*base.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("bits_per_byte", DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = Model(*shared.value)
        for batch in batches:
            lettered = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            texts = batch.column(names.index("text"))
            bits, sizes = score_texts(frozen, texts) if frozen.langs else (None, np.zeros(len(texts)))
            label, score, mean = _decide(frozen.langs, bits, sizes, lettered.astype(bool))
            columns = [*batch.columns[:-1], pa.array(label, pa.string()), pa.array(score), mean]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    marked = base.withColumn("__letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return marked.mapInArrow(predict, schema)


def _decide(langs, bits, sizes, lettered):
    if not langs:
        n = len(sizes)
        return [UNDETERMINED] * n, np.zeros(n), pa.nulls(n, pa.float64())
    best = bits.argmin(axis=1)
    least = bits.min(axis=1)
    share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
    label = [langs[k] if ok else UNDETERMINED for k, ok in zip(best, lettered, strict=True)]
    mean = pa.array(least / np.maximum(sizes, 1), pa.float64(), mask=~lettered)
    return label, np.where(lettered, share, 0.0), mean


def fit(docs: DataFrame, eligible: Column, **bounds) -> Model:
    """A model from the bounded training texts of ``docs``; the only rows that
    reach the driver, at most ``TRAIN_BYTES`` of a language."""
    texts: dict[str, list[str]] = {}
    for lang, text in training_texts(docs, eligible, **bounds).collect():
        texts.setdefault(lang, []).append(text)
    return learn(texts)


def not_held_out() -> Column:
    """Rows that may be learned from: crc32 of doc_id as text, mod 3, not 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1, F.lit(True))


def accepted(docs: DataFrame, model: Model, max_bits: float = MAX_BITS) -> DataFrame:
    """The documents in one of the learned languages, columns as they are.
    Rejected are texts without a letter, and texts that cost more than
    ``max_bits`` a byte in their best language: for plain bytes it is 8."""
    found = identify(docs, model)
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "bits_per_byte")]
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("bits_per_byte") <= max_bits)).select(*names)
