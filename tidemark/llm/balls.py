"""SimHash near-duplicates by meeting in the middle.

Two fingerprints that differ in at most four bits have a variant in common that
is at most two bits away from either. So every fingerprint emits all of its
2,081 variants within two bits, equal variants meet, and what meets is a link.

A variant travels as its first bits: fingerprints are shuffled on the variants
of their first bits, with the number of flips that are left, and the other bits
are flipped where they meet. That is 37 rows a fingerprint instead of 2,081 for
8 bits. A group of more than ``VARIANTS`` is dealt out again by further bits.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import components, saved

BITS = 64
SHINGLE = 4
RADIUS = 4
HALF = RADIUS // 2
SEED = 42
# Variants that are compared in one call, and the bits by which a group that has
# more is dealt out again.
VARIANTS = 1 << 21
FURTHER = 8
# Bytes of a text that are cut into words at a time.
PART = 1 << 20

_SPACE = b" \t\n\x0b\x0c\r"


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in runs of about ``PART`` bytes."""
    at = 0
    while at < len(text):
        to = min(at + PART, len(text))
        while to < len(text) and text[to] not in _SPACE:
            to += 1
        yield text[at:to].split()
        at = to


def fingerprint(text: bytes) -> int:
    """A bit is 1 if it is set in more than half of the hashes of the text's
    shingles, repeats included; 0 for a text without words."""
    votes, n, last = np.zeros(BITS, np.int64), 0, []
    for part in _parts(text.lower()):
        words = last + part
        ends = list(itertools.accumulate(map(len, words), lambda a, b: a + b + 1))
        joined = b" ".join(words)
        found = [
            xxhash.xxh64_intdigest(joined[end - len(word) : stop], SEED)
            for word, end, stop in zip(words, ends, ends[SHINGLE - 1 :])
        ]
        votes += _votes(found)
        n += len(found)
        last = words[-(SHINGLE - 1) :]
    if not n and last:
        votes, n = _votes([xxhash.xxh64_intdigest(b" ".join(last), SEED)]), 1
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def _votes(hashes: list[int]) -> np.ndarray:
    total = np.zeros(BITS, np.int64)
    values = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(values), 1 << 14):
        total += np.unpackbits(values[at : at + (1 << 14)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return total


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint of every text; NULL counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in batch.column("text")]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], ["doc_id", "fp"])

    schema = StructType([docs.schema["doc_id"], StructField("fp", LongType())])
    return docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, schema)


@cache
def _masks(bits: int, flips: int) -> np.ndarray:
    """Every mask of at most so many of the low bits."""
    masks = [0]
    for k in range(1, flips + 1):
        masks += [sum(1 << b for b in chosen) for chosen in itertools.combinations(range(bits), k)]
    return np.array(masks, np.uint64)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _dealt(rows: DataFrame, start: int, count: int) -> DataFrame:
    """Rows (fp, group, left) to the groups of their variants in the ``count``
    bits after the first ``start`` ones."""
    if not count:
        return rows
    shift = BITS - start - count
    ways = F.lit(None)
    for left in range(HALF + 1):
        steps = [
            F.struct(F.lit(_signed(int(m) << shift)).alias("mask"), F.lit(left - int(m).bit_count()).alias("left"))
            for m in _masks(count, left)
        ]
        ways = F.when(F.col("left") == left, F.array(*steps)).otherwise(ways)
    moved = rows.withColumn("way", F.explode(ways))
    # The group is the bits so far of the variant; flips so far are in it.
    own = F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("way.mask")), shift).bitwiseAND(F.lit((1 << count) - 1))
    group = F.shiftleft(F.col("group"), count).bitwiseOR(own)
    return moved.select("fp", group.alias("group"), F.lit(start + count).alias("bits"), F.col("way.left").alias("left"))


def _links(table: pa.Table) -> pa.Table:
    """(a, b): links between fingerprints that have a variant in common, as many
    as it takes to connect them: of those that share a variant the smallest with
    each other one, less the links between fingerprints that are connected."""
    bits = BITS - table.column("bits")[0].as_py()
    fps = table.column("fp").to_numpy().view(np.uint64)
    order = np.argsort(fps)
    fps, left = fps[order], table.column("left").to_numpy()[order]
    low = np.uint64((1 << bits) - 1)
    variants, owners = [], []
    for flips in range(HALF + 1):
        who = np.flatnonzero(left == flips)
        masks = _masks(bits, min(flips, bits))
        variants.append(((fps[who, None] ^ masks) & low).ravel())
        owners.append(np.repeat(who.astype(np.int32), len(masks)))
    values, who = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(values)
    values, who = values[order], who[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    lead = np.repeat(np.minimum.reduceat(who, first), np.diff(np.append(first, len(who))))
    pairs = np.unique((lead.astype(np.int64) * len(fps) + who)[lead != who])
    left, right = _forest(len(fps), pairs // len(fps), pairs % len(fps))
    return pa.table({"a": fps[left].view(np.int64), "b": fps[right].view(np.int64)})


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[list[int], list[int]]:
    """The pairs that connect something which earlier ones do not."""
    root = list(range(n))
    kept: tuple[list[int], list[int]] = ([], [])

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept[0].append(a)
            kept[1].append(b)
    return kept


def close_links(fps: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints (a column ``fp``) that differ
    in at most four bits, enough of them to connect all that are connected. In a
    set that shares a variant, any two of which are links, one row is held
    against the others, and a group gives fewer links than it has rows; so a
    large set does not become all of its pairs."""
    n = fps.count()
    bits = min(max(math.ceil(math.log2(max(n, 1) * 4096 / VARIANTS)), 0), 24)
    start = fps.select("fp", F.lit(0).cast("long").alias("group"), F.lit(0).alias("bits"), F.lit(HALF).alias("left"))
    rows = saved(_dealt(start, 0, bits), "ball-rows")
    found = []
    while True:
        if bits == BITS:
            # A group is a variant.
            least = rows.groupBy("group").agg(F.min("fp").alias("a"))
            found.append(rows.join(least, "group").where("a != fp").select("a", F.col("fp").alias("b")))
            break
        variants = F.element_at(F.array(*[F.lit(len(_masks(BITS - bits, k))) for k in range(HALF + 1)]), F.col("left") + 1)
        sizes = rows.groupBy("group").agg(F.sum(variants).alias("variants"))
        hot = saved(sizes.where(F.col("variants") > VARIANTS).select("group"), "ball-hot")
        small = rows.join(hot, "group", "left_anti")
        found.append(small.groupBy("group").applyInArrow(_links, "a long, b long"))
        if hot.isEmpty():
            break
        more = min(FURTHER, BITS - bits)
        rows, bits = saved(_dealt(rows.join(hot, "group", "left_semi"), bits, more), "ball-rows"), bits + more
    links = reduce(DataFrame.unionByName, found).distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def near_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id,
    text; other columns are not looked at).

    NULL, empty and blank texts have the fingerprint zero, which links like any
    other. Copies and repeated rows share a fingerprint, take part once, and get
    a row each. component_id is the smallest doc_id of the component, not NULL
    if one is not. A very long text is read in parts. No rows give no rows.
    """
    fps = saved(fingerprinted(docs), "fingerprints")
    distinct = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    links = components(close_links(distinct.select("fp")))
    rooted = distinct.join(links, distinct["fp"] == links["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = saved(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def hexadecimal(fp: Column) -> Column:
    """16 lowercase digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
