"""Repeated passages by suffix arrays around anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

# Bytes of a passage that may not be repeated, and of an anchor in it.
LENGTH = 200
ANCHOR = 50
# A group of more contexts than this is split by what it shares.
LARGE = 4096
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_RUN = 1 << 20
_OCCURRENCE, _PARTNER, _EDGE = 1, 2, 3
# Fewer contexts are compared one by one, up to so many by tables of all pairs.
_FEW = 6
_PAIRED = 512
# More than two contexts share; twice as much fits the type.
_MUCH = np.int16(1 << 13)
_ROWS = "kind int, group long, content long, n int, doc long, at long, left int, right int"
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes:
    """Hashes of any parts of a buffer, equal for equal bytes."""

    def __init__(self, data: np.ndarray, base: int):
        n = len(data)
        powers = np.cumprod(np.full(n, base, np.uint64))
        terms = _mix(data.astype(np.uint64) + np.uint64(1)) * powers
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        back = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
        back[0] = 1
        self.back = np.cumprod(back)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, size: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(text, at, hash, content, left, right) of the anchors of texts that lie
    end to end: in every ``length`` bytes of a text the run of ``size`` bytes
    with the least hash, the first of equal ones. Equal passages of that length
    have equal anchors at equal places. The context of an anchor, ``left``
    bytes before it and ``right`` from it on, holds every passage whose anchor it
    is, as far as its text goes; ``content`` is a hash of it.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64), none, none
    ends = np.append(starts[1:], len(data))
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    first = _Hashes(data, _BASES[0])
    at = np.arange(len(data) - size + 1)
    hashes = first.of(at, at + size)
    key = (hashes & ~np.uint64((1 << 24) - 1)) | at.astype(np.uint64)
    least = _least(key, length - size + 1)
    whole = owner[: len(data) - length + 1] == owner[length - 1 :]
    at = np.unique((least[whole] & np.uint64((1 << 24) - 1)).astype(np.int64))
    text = owner[at]
    low = np.maximum(at - (length - size), starts[text])
    high = np.minimum(at + length, ends[text])
    content = _mix(_Hashes(data, _BASES[1]).of(low, high) + ((at - low) << 32 | (high - at)).astype(np.uint64))
    return text, at - starts[text], hashes[at], content, at - low, high - at


def _all_anchors(texts: list[bytes], length: int, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The anchors of texts, some texts or a part of one at a time."""
    at = 0
    while at < len(texts):
        to, total = at + 1, len(texts[at])
        if total > _RUN:
            whole = np.frombuffer(texts[at], np.uint8)
            parts = []
            for start in range(0, total, _RUN):
                # Enough on both sides for whole passages and contexts.
                low, high = max(0, start - 2 * length), min(total, start + _RUN + 2 * length)
                _, place, *rest = anchors(whole[low:high], np.zeros(1, np.int64), length, size)
                place = place + low
                fit = (place >= start) & (place < start + _RUN)
                parts.append([place[fit], *(x[fit] for x in rest)])
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            yield np.full(len(columns[0]), at), *columns
        else:
            while to < len(texts) and total + len(texts[to]) <= _RUN:
                total += len(texts[to])
                to += 1
            group = texts[at:to]
            starts = np.concatenate([[0], np.cumsum([len(t) for t in group])[:-1]]).astype(np.int64)
            text, *rest = anchors(np.frombuffer(b"".join(group), np.uint8), starts, length, size)
            yield text + at, *rest
        at = to


def _batch(kind, group, content, n, doc, at, left, right) -> pa.RecordBatch:
    size = len(group)
    fill = lambda x, t: np.full(size, x, t) if np.isscalar(x) else np.asarray(x).astype(t)
    columns = [fill(kind, np.int32), group.view(np.int64), content.view(np.int64), fill(n, np.int32)]
    columns += [fill(doc, np.int64), fill(at, np.int64), fill(left, np.int32), fill(right, np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_NAMES)


def _find(length: int, size: int):
    """Anchors of a task's documents. Of those with one context it sends one,
    marked as repeated, however many there are; their places it already knows
    to be repeated, and sends as such, to where their document goes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in _pieces(batches):
            texts = [t.encode() if t else b"" for t in batch.column(1).to_pylist()]
            docs = batch.column(0).to_numpy()
            for text, at, group, content, left, right in _all_anchors(texts, length, size):
                found.append((group, content, docs[text], at, left.astype(np.int32), right.astype(np.int32)))
        if not sum(len(x[0]) for x in found):
            return
        group, content, doc, at, left, right = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((at, doc, content, group))
        group, content, doc, at, left, right = (x[order] for x in (group, content, doc, at, left, right))
        new = np.append(True, (group[1:] != group[:-1]) | (content[1:] != content[:-1]))
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(group)))
        several = np.repeat(count > 1, count)
        step = 1 << 17
        for a in range(0, len(first), step):
            k = first[a : a + step]
            yield _batch(0, group[k], content[k], np.minimum(count[a : a + step], 2), doc[k], at[k], left[k], right[k])
        known = np.flatnonzero(several)
        for a in range(0, len(known), step):
            k = known[a : a + step]
            yield _batch(_OCCURRENCE, _mix(group[k] ^ content[k]), content[k], 2, doc[k], at[k], left[k], right[k])

    return find


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors in order of (kind, group, content). Contexts that occur again are
    repeated from end to end. Other anchors whose bytes occur again become
    edges, to be compared with one of each other context of their group. The
    rows of the last context wait for what follows."""
    waiting = None
    before = None  # the group of the context before those that wait
    for batch in _ended(batches):
        if batch is None:
            columns, last = waiting, True
        else:
            columns = [c.to_numpy() for c in batch.columns]
            done = columns[0] != 0
            if done.any():
                yield _batch(columns[0][done], *(c[done] for c in columns[1:]))
                columns = [c[~done] for c in columns]
            if waiting is not None:
                columns = [np.concatenate(x) for x in zip(waiting, columns, strict=True)]
            last = False
        if columns is None or not len(columns[0]):
            continue
        _, group, content, n, doc, at, left, right = columns
        new = np.append(True, (group[1:] != group[:-1]) | (content[1:] != content[:-1]))
        first = np.flatnonzero(new)
        runs = first if last else first[:-1]
        waiting = [c[first[-1] :] for c in columns]
        of = group[first]
        prior = np.append(before is not None and before == of[0], of[1:] == of[:-1])
        if len(first) > 1:
            before = of[-2]
        if not len(runs):
            continue
        end = len(group) if last else first[-1]
        count = np.diff(np.append(runs, end))
        multi = prior[: len(runs)].copy()
        after = of[1:] == of[:-1]
        multi[: len(after)] |= after[: len(runs)]
        repeated = (count > 1) | (n[runs] > 1)
        again = np.flatnonzero(np.repeat(repeated, count) & (n[:end] == 1))
        yield _batch(
            _OCCURRENCE, _mix(group[again].view(np.uint64) ^ content[again].view(np.uint64)), content[again], 2, doc[again], at[again], left[again], right[again]
        )
        ask = runs[multi]
        kind = np.where(repeated[multi], _PARTNER, _EDGE)
        yield _batch(kind, group[ask], content[ask], 1, doc[ask], at[ask], left[ask], right[ask])


def _ended(batches):
    yield from batches
    yield None


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high - 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, length) of the common-prefix intervals of a suffix array
    whose neighbours share ``lcp`` bytes, as far as they share ``least``: the
    inner nodes of its suffix tree, by one scan with a stack."""
    stack: list[tuple[int, int]] = []  # first suffix, length
    for i, length in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][1] > length:
            first, shared = stack.pop()
            if shared >= least:
                yield first, i, shared
        if not stack or stack[-1][1] < length:
            stack.append((first, length))


def maximal_repeats(contexts: list[tuple[bytes, bytes]], length: int) -> Iterator[tuple[list[int], int, int]]:
    """(members, left, right) of the maximal repeats of ``length`` bytes or more
    across the middle of contexts (bytes before it backwards, bytes after it).

    The suffixes that start in the middle are sorted; each interval of that
    array shares ``right`` bytes. Its members are sorted by what is left of
    them, and each interval of that order shares ``left`` bytes. A repeat is
    maximal to the left as its members differ there, and to the right if they
    are not all in one smaller interval.
    """
    order = sorted(range(len(contexts)), key=lambda i: contexts[i][1])
    lcp = [common(contexts[a][1], contexts[b][1]) for a, b in zip(order[:-1], order[1:], strict=True)]
    longest = max((len(left) for left, _ in contexts), default=0)
    for first, last, right in intervals(lcp, max(length - longest, 0)):
        need = max(length - right, 0)
        rank = sorted(
            (r for r in range(first, last + 1) if len(contexts[order[r]][0]) >= need),
            key=lambda r: contexts[order[r]][0],
        )
        before = [common(contexts[order[a]][0], contexts[order[b]][0]) for a, b in zip(rank[:-1], rank[1:], strict=True)]
        for low, high, left in intervals(before, need):
            members = rank[low : high + 1]
            if min(lcp[min(members) : max(members)]) == right:
                yield [order[r] for r in members], left, right


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one route after another."""
    waiting: list[tuple] = []
    for batch in _pieces(batches):
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if waiting and row[0] != waiting[0][0]:
                yield waiting
                waiting = []
            waiting.append(row)
    if waiting:
        yield waiting


def _repeats(rows: list[tuple]) -> pa.RecordBatch:
    group, doc, at, left, right = (np.array(c, np.int64) for c in zip(*rows, strict=True))
    return _batch(_OCCURRENCE, group, np.zeros(len(group), np.int64), 2, doc, at, left, right)


def _sorted(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the parts in order, and what neighbours share."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    sizes = np.array([len(parts[i]) for i in order])
    width = int(sizes.max())
    padded = np.frombuffer(b"".join(parts[i].ljust(width + 1, b"\0") for i in order), np.uint8).reshape(-1, width + 1)
    differ = padded[1:] != padded[:-1]
    differ[:, width] = True
    return np.array(order), np.minimum(differ.argmax(1), np.minimum(sizes[1:], sizes[:-1])).astype(np.int16)


def _shared(lcp: np.ndarray) -> np.ndarray:
    """What each two of sorted parts share; of a part and itself, very much."""
    n = len(lcp) + 1
    upper = np.where(np.tri(n, dtype=bool), _MUCH, np.append(np.int16(0), lcp)[None])
    upper = np.minimum.accumulate(upper, axis=1)
    return np.minimum(upper, upper.T)


class _Least:
    """The least of any run of values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(values) > 1 << len(self.levels) - 1:
            step = 1 << len(self.levels) - 1
            last = self.levels[-1]
            self.levels.append(np.minimum(last, np.append(last[step:], np.full(min(step, len(last)), _MUCH))))
        self.table = np.stack(self.levels)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        level = np.frexp(end - start)[1] - 1
        return np.minimum(self.table[level, start], self.table[level, end - (1 << level)])


def _best(order: np.ndarray, lcp: np.ndarray, other: np.ndarray, other_lcp: np.ndarray, length: int) -> np.ndarray:
    """What each context shares at most, on the one side, with another that it
    shares ``length`` bytes or more with on both sides; -1 if with none.

    All that share as much as some level on the other side are a group. In it
    the nearest in the order of this side share most. What they share falls
    with the level, so that the least level at which it is enough counts."""
    n = len(order)
    rank = np.empty(n, np.int64)
    rank[other] = np.arange(n)
    placed = rank[order]
    least, out = _Least(lcp), np.full(n, -1, np.int64)
    kind = np.uint16 if n <= 1 << 16 else np.int64
    for level in np.unique(other_lcp).tolist():
        group = np.append(0, np.cumsum(other_lcp < level)).astype(kind)[placed]
        at = np.argsort(group, kind="stable")
        near = np.flatnonzero(group[at[1:]] == group[at[:-1]])
        low, high = at[near], at[near + 1]
        share = least.of(low, high)
        enough = share >= length - level
        share, low, high = share[enough], low[enough], high[enough]
        best = np.full(n, -1, np.int64)
        best[low] = share
        best[high] = np.maximum(best[high], share)
        out = np.where(out < 0, best, out)
        if out.min() >= 0:
            break
    found = np.empty(n, np.int64)
    found[order] = out
    return found


def widest(contexts: list[tuple[bytes, bytes]], length: int) -> Iterator[tuple[int, int, int]]:
    """(context, left, right) of contexts (bytes before the middle backwards,
    bytes after it) that share ``length`` bytes or more across it with another:
    the most that they share on either side with such a one.

    Few contexts are held against each other; of many, all that share some
    bytes on one side are looked through by their order on the other."""
    n = len(contexts)
    if n < _FEW:
        most: dict[int, tuple[int, int]] = {}
        for i in range(n):
            for j in range(i):
                left, right = (common(a, b) for a, b in zip(contexts[i], contexts[j], strict=True))
                if left + right >= length:
                    for m in (i, j):
                        back, on = most.get(m, (0, 0))
                        most[m] = max(back, left), max(on, right)
        yield from ((m, *both) for m, both in most.items())
        return
    (before, before_lcp), (after, after_lcp) = (_sorted([c[side] for c in contexts]) for side in (0, 1))
    if n <= _PAIRED:
        rank = np.empty(n, np.int64)
        rank[before] = np.arange(n)
        placed = rank[after]
        left, right = _shared(before_lcp)[np.ix_(placed, placed)], _shared(after_lcp)
        np.fill_diagonal(left, -_MUCH)
        fit = left + right >= length
        found = np.empty((2, n), np.int64)
        found[:, after] = [np.where(fit, side, -1).max(1) for side in (left, right)]
    else:
        found = np.stack([
            _best(before, before_lcp, after, after_lcp, length), _best(after, after_lcp, before, before_lcp, length)
        ])
    hit = np.flatnonzero((found >= 0).all(0))
    yield from zip(hit.tolist(), *found[:, hit].tolist(), strict=True)


def _cover(rows: list[tuple], length: int) -> Iterator[tuple]:
    """Of each context the bytes that its repeats cover: they all meet where its
    anchor begins, so that the widest to either side are one run."""
    contexts = [(raw[:left][::-1], raw[left:]) for _, _, _, left, raw in rows]
    for m, left, right in widest(contexts, length):
        yield 0, rows[m][1], rows[m][2], left, right


def _compare(length: int, found_in: Callable[[list[tuple], int], Iterator[tuple]]):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _groups(batches):
            for found in found_in(rows, length):
                out.append(found)
                # Repeats within repeats can be many more than the contexts.
                if len(out) == _SENT:
                    yield _repeats(out)
                    out = []
        if out:
            yield _repeats(out)

    return compare


def _group(rows: list[tuple], length: int) -> Iterator[tuple]:
    contexts = [(raw[:left][::-1], raw[left:]) for _, _, _, left, raw in rows]
    for members, left, right in maximal_repeats(contexts, length):
        back, on = contexts[members[0]]
        same = hashlib.blake2b(back[:left][::-1] + on[:right], digest_size=8).digest()
        name = int.from_bytes(same, "little", signed=True)
        for m in members:
            yield name, rows[m][1], rows[m][2], left, right


# Bytes of contexts that a task holds before it passes them on, rows of texts
# that it turns into Python objects at a time, and repeats that it sends at once.
_HELD = 4 << 20
_PIECE = 256
_SENT = 1 << 16


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, _PIECE):
            yield batch.slice(a, _PIECE)


def _routes(raw: bytes, left: int, length: int, size: int, step: int) -> list[int]:
    """Where a context of a split anchor goes: two that share a passage share
    one of these parts."""
    starts = range(0, min(left, length - size) + 1, step)
    ends = [(j, left + max(size, length - step - j)) for j in starts]
    fit = [(left - j, end) for j, end in ends if end <= len(raw)]
    if not fit:
        return []
    low, high = np.array(fit, np.int64).T
    routes = _Hashes(np.frombuffer(raw, np.uint8), _BASES[1]).of(low, high) + (left - low).astype(np.uint64)
    return routes.view(np.int64).tolist()


def _contexts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["route", "doc", "at", "left", "raw"])


def occurrences(
    docs: DataFrame, length: int = LENGTH, size: int = ANCHOR, large: int = LARGE, cover: bool = False
) -> DataFrame:
    """(group, doc, start, length): every occurrence of groups of repeated
    bytes, at least ``length`` of them. ``doc`` is xxhash64(doc_id, text).

    Any two equal passages of ``length`` bytes have the same anchor, so only
    anchors that occur again, and ``length`` bytes around them, are compared.
    Contexts that are equal are one group. The others of an anchor are a sparse
    suffix array, whose common-prefix intervals give the maximal repeats with
    all members. A repeat that is longer than a context shows in several groups,
    one for each of its anchors, which overlap.

    Anchors with equal contexts are combined in each task before the shuffle.
    An anchor with very many different contexts is split: two that share a
    passage also share seven eighths of its bytes, from one of a few places on.

    With ``cover``, the same bytes are covered, but the repeats of a context,
    which may be far more than the contexts, come as one row without a group.
    """
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc"), "text")
    found = keyed.mapInArrow(_find(length, size), _ROWS)
    # Known occurrences go where their document does.
    routed = found.repartition(F.when(F.col("kind") == 0, F.col("group")).otherwise(F.col("doc")))
    judged = saved(routed.sortWithinPartitions("kind", "group", "content").mapInArrow(_classify, _ROWS), "anchors", release=True)
    asked = judged.where(F.col("kind") != _OCCURRENCE)
    groups = asked.groupBy("group").agg(F.max("kind").alias("most"), F.count("*").alias("contexts"))
    groups = groups.where(F.col("most") == _EDGE).select("group", (F.col("contexts") > large).alias("many"))
    by_doc = (
        asked.join(groups, "group")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("group", "at", "left", "right", "many")).alias("anchors"))
    )
    wanted = keyed.join(by_doc, "doc")

    step = max(1, length // 8)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in _pieces(batches):
            for doc, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode()
                for p in places:
                    at, left = p["at"], p["left"]
                    raw = data[at - left : at + p["right"]]
                    if p["many"]:
                        routes = _routes(raw, left, length, size, step)
                    else:
                        routes = [p["group"]]
                    rows += [(route, doc, at, left, raw) for route in routes]
                    held += len(routes) * len(raw)
                    # A few MB at a time, whatever the batch holds.
                    if held > _HELD:
                        yield _contexts(rows)
                        rows, held = [], 0
        if rows:
            yield _contexts(rows)

    contexts = wanted.mapInArrow(cut, "route long, doc long, at long, left int, raw binary")
    compared = contexts.repartition("route").sortWithinPartitions("route").mapInArrow(_compare(length, _cover if cover else _group), _ROWS)
    both = judged.where(F.col("kind") == _OCCURRENCE).unionByName(compared)
    return both.select(
        "group", "doc", (F.col("at") - F.col("left")).alias("start"), (F.col("left") + F.col("right")).alias("length")
    )


def without_repeats(docs: DataFrame, names: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """The named columns, ``n_bytes``, ``spans`` (array of (start, end), the
    maximal removed runs) and ``kept``: the bytes of the text that no repeated
    passage of 200 bytes covers, wherever the other occurrence is.

    Bytes are those of the whole text in UTF-8; kept ones may be no text any
    more. NULL and empty texts, and those of fewer bytes than a passage, lose
    nothing. Passages do not go across texts. Equal rows are copies of each
    other.
    """
    found = occurrences(docs, cover=True, **options)
    covered = found.groupBy("doc").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("__covered")
    )
    keyed = docs.select(*names, F.xxhash64("doc_id", "text").alias("__doc"), F.col("text").alias("__text"))
    rows = keyed.join(covered.withColumnRenamed("doc", "__doc"), "__doc", "left").drop("__doc")
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            sizes, spans, kept = [], [], []
            texts, places = (batch.column(k).to_pylist() for k in (-2, -1))
            for text, covered in zip(texts, places, strict=True):
                data = (text or "").encode()
                runs: list[list[int]] = []
                for start, end in sorted((p["start"], p["end"]) for p in covered or ()):
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([start, end])
                cuts = [0, *(x for run in runs for x in run), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
                sizes.append(len(data))
                spans.append([{"start": a, "end": b} for a, b in runs])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                names=[*names, "n_bytes", "spans", "kept"],
            )

    return rows.mapInArrow(remove, f"{kinds}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
