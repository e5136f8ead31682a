"""Byte-level byte-pair encoding: ranked merges over the bytes of words."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from tidemark.llm.common import let, saved
from tidemark.llm.kept import content_key, slices, word_encoder

# Java's form of the pattern: white space as Unicode defines it.
JAVA_FLAGS = "(?U)"
_BUCKETS = 1 << 16
# The most frequent words, which are folded once and then looked up.
DICTIONARY = 1 << 16
_NEVER = (1 << 31) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a piece in base64 and its rank on each line."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(piece): int(rank) for piece, rank in pairs}


def _literal(entries: dict[str, object], value: str) -> Column:
    """A map as a literal. Spark looks a key up in a map by going through it, so
    the map is cut into buckets by the key's hash."""
    buckets: list[dict[str, object]] = [{} for _ in range(_BUCKETS)]
    for key, found in entries.items():
        buckets[xxhash.xxh64_intdigest(key.encode(), seed=42) % _BUCKETS][key] = found
    return F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{value}>>")


def _find(table: Column, key: Column) -> Column:
    bucket = F.xxhash64(key).bitwiseAND(F.lit(_BUCKETS - 1)).cast("int")
    return F.try_element_at(F.get(table, bucket), key)


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal map; keys are the pieces in hex."""
    return _literal({piece.hex().upper(): rank for piece, rank in ranks.items()}, "int")


def _rank(table: Column, piece: Column) -> Column:
    return F.coalesce(_find(table, piece), F.lit(_NEVER))


def encode_word(table: Column, word: Column) -> Column:
    """The ids of a word (hex of its bytes), as the bytes merge: of all
    neighbours that form a known piece, those with the lowest rank, the first
    among equals, become one piece, until none do."""
    last = (F.length(word) / 2).cast("int") - 1
    single = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(word, i * 2 + 1, F.lit(2)))
    pairs = F.when(last < 1, F.array().cast("array<int>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))), lambda i: _rank(table, F.substring(word, i * 2 + 1, F.lit(4))))
    )

    def merge(state: Column, at: Column) -> Column:
        p, r = state["p"], state["r"]
        n = F.size(p)
        joined = F.concat(F.get(p, at - 1), F.get(p, at))

        def with_piece(piece: Column) -> Column:
            before = F.when(at > 1, F.array(_rank(table, F.concat(F.get(p, at - 2), piece)))).otherwise(F.array().cast("array<int>"))
            after = F.when(at < n - 1, F.array(_rank(table, F.concat(piece, F.get(p, at + 1))))).otherwise(F.array().cast("array<int>"))
            return F.struct(
                F.concat(F.slice(p, F.lit(1), at - 1), F.array(piece), F.slice(p, at + 2, n)).alias("p"),
                F.concat(F.slice(r, F.lit(1), F.greatest(at - 2, F.lit(0))), before, after, F.slice(r, at + 2, n)).alias("r"),
            )

        return let(joined, with_piece)

    def step(state: Column, _: Column) -> Column:
        least = F.coalesce(F.array_min(state["r"]), F.lit(_NEVER))
        return let(
            least,
            lambda m: F.when(m == _NEVER, state).otherwise(
                let(F.array_position(state["r"], m).cast("int"), lambda at: merge(state, at))
            ),
        )

    start = F.struct(single.alias("p"), pairs.alias("r"))
    steps = F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0)))
    return F.aggregate(
        steps, start, step, lambda state: F.transform(state["p"], lambda x: _rank(table, x))
    )


def matches(pattern: str) -> Column:
    """The words of ``text``, none for NULL."""
    found = F.regexp_extract_all("text", F.lit(JAVA_FLAGS + pattern), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def frequent_words(docs: DataFrame, ranks: dict[bytes, int], pattern: str, size: int = DICTIONARY) -> Column:
    """The ids of the ``size`` most frequent distinct words of all documents,
    folded once each, as a literal map. A bounded number of words reaches the
    driver; how many changes the work, not the ids."""
    words = docs.select(F.explode(matches(pattern)).alias("word"))
    top = saved(words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(size), "words")
    folded = top.repartition("word").select("word", let(rank_map(ranks), lambda t: encode_word(t, _hex("word"))).alias("ids"))
    return _literal({r.word: list(r.ids) for r in folded.collect()}, "array<int>")


def _hex(word: str | Column) -> Column:
    return F.hex((F.col(word) if isinstance(word, str) else word).cast("binary"))


def encode_natively(docs: DataFrame, ranks: dict[bytes, int], pattern: str, size: int = DICTIONARY) -> DataFrame:
    """The documents with ``ids``, by higher-order functions alone: the form that
    does not hold at size (README), and that the other one is tested against.

    A text's words are the matches of the pattern. The ids of frequent distinct
    words are looked up, those of the others folded in place: nothing but the
    counts of words is shuffled, and texts stay where they are.
    """
    known = frequent_words(docs.select("text"), ranks, pattern, size)
    words = F.col("__words")

    def ids(ranked: Column, looked: Column) -> Column:
        return F.flatten(
            F.transform(words, lambda w: F.coalesce(_find(looked, w), encode_word(ranked, _hex(w))))
        )

    # Both literals stand in the plan once.
    both = let(rank_map(ranks), lambda ranked: let(known, lambda looked: ids(ranked, looked)))
    return docs.drop("ids").withColumn("__words", matches(pattern)).withColumn("ids", both).drop("__words")


def _joined(ids: Column, by_id: list[bytes]) -> Column:
    """The binary piece of each id, one after another."""
    table = F.split(F.lit(" ".join(piece.hex() for piece in by_id)), " ")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that ids stand for."""
    by_id = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        by_id[rank] = piece
    return _joined(ids, by_id)


def little_endian(ids: Column, n_ids: int) -> Column:
    """Ids as unsigned 32-bit integers, low byte first."""
    return _joined(ids, [i.to_bytes(4, "little") for i in range(n_ids)])


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: of all neighbours that form a known piece, those with
    the lowest rank, the first among equals, become one piece, until none do."""
    if word in ranks:
        return [ranks[word]]
    pieces = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i : i + 2], _NEVER) for i in range(len(word) - 1)]
    while pairs and (least := min(pairs)) < _NEVER:
        at = pairs.index(least)
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(pieces[at - 1] + pieces[at], _NEVER)
        if at < len(pairs):
            pairs[at] = ranks.get(pieces[at] + pieces[at + 1], _NEVER)
    return [ranks[p] for p in pieces]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """The documents with ``ids``, the token ids of the whole text, ``packed``,
    the same as unsigned 32-bit integers, low byte first, and ``decoded``, the
    bytes that they stand for (columns of these names are replaced). A NULL or
    empty text has none.

    Spark cuts texts into words, the matches of the pattern. A worker folds the
    merges over each distinct word that it meets, keeps a bounded number of
    them, and joins the ids in the words' places; ids are decoded piece by
    piece. Nothing is shuffled.
    """
    docs = docs.drop("ids", "packed", "decoded")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    key = content_key("ranks", sorted(ranks.items()))
    added = [
        StructField("ids", ArrayType(IntegerType())),
        StructField("packed", BinaryType()),
        StructField("decoded", BinaryType()),
    ]
    schema = StructType([*docs.schema.fields, *added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        pieces = [b""] * (max(known.values(), default=-1) + 1)
        for piece, rank in known.items():
            pieces[rank] = piece
        encoder = word_encoder(key, lambda: lambda words: [fold(w.encode(), known) for w in words])
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            for at, to in slices(lists.offsets.to_numpy()):
                flat, ends = encoder.encode(lists[at:to])
                ends = np.concatenate([[0], ends]).astype(np.int32)
                ids = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                texts = [b"".join(map(pieces.__getitem__, x.tolist())) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c[at:to] for c in batch.columns[:-1]],
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view("<i4"))),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                        pa.array(texts, pa.binary()),
                    ],
                    names=schema.names,
                )

    return docs.withColumn("__words", matches(pattern)).mapInArrow(work, schema)


def with_ids(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """The documents with ``ids``, ``n_tokens`` and ``round_trip``: whether the
    ids decode to the bytes of the text (NULL text: as empty)."""
    out = encode(docs.drop("n_tokens", "round_trip"), ranks, pattern)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return out.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("round_trip", same).drop("packed", "decoded")
