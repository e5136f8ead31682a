"""Ids of distinct words, kept by the Python workers that meet them."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa

# Words that are encoded at a time, and that a worker keeps.
AT_A_TIME = 1 << 20
KEPT_WORDS = 400_000

Encode = Callable[[list[str]], list[list[int]]]


class WordEncoder:
    """Ids of texts from those of their words. Each distinct word is encoded
    once, as long as it is kept; of the words met later, once for each call."""

    def __init__(self, encode: Encode):
        self.fresh = encode
        self.kept: dict[str, bytes] = {}

    def encode(self, texts: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, as unsigned 32-bit integers, and where those of
        each text end. Texts are lists of words."""
        offsets = texts.offsets.to_numpy()
        low, high = int(offsets[0]), int(offsets[-1])
        coded = texts.values.slice(low, high - low).dictionary_encode()
        ids, ends = self._distinct(coded.dictionary.to_pylist())
        place = coded.indices.to_numpy()
        sizes = np.diff(ends, prepend=0)[place]
        upto = np.cumsum(sizes)
        # Each word's ids lie together among those of the distinct words.
        shift = np.repeat(ends[place] - upto, sizes)
        flat = ids[np.arange(len(shift)) + shift]
        upto = np.concatenate([[0], upto])
        return flat, upto[offsets[1:] - low]

    def _distinct(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, one after another, and where each ends."""
        kept = self.kept
        fresh = [w for w in words if w not in kept]
        new = {w: np.array(ids, "<u4").tobytes() for w, ids in zip(fresh, self.fresh(fresh), strict=True)}
        found = [new[w] if w in new else kept[w] for w in words]
        if len(kept) < KEPT_WORDS:
            kept.update(new)
        ends = np.cumsum([len(x) // 4 for x in found], dtype=np.int64)
        return np.frombuffer(b"".join(found), "<u4"), ends


def content_key(*parts: object) -> str:
    """A digest that tells vocabularies apart by what they hold."""
    digest = hashlib.sha256()
    for part in parts:
        digest.update(repr(part).encode())
    return digest.hexdigest()


def word_encoder(key: Hashable, make: Callable[[], Encode]) -> WordEncoder:
    """The worker's own encoder of a vocabulary: it lives as long as the worker.

    Tasks bring this package with them, a new copy each, so the encoders are
    kept by a module that the worker itself has imported. ``key`` must tell
    vocabularies apart; the two last used are kept.
    """
    encoders: dict[Hashable, WordEncoder] = vars(sys).setdefault("_tidemark_word_encoders", {})
    encoder = encoders.pop(key, None)
    if encoder is None:
        encoder = WordEncoder(make())
        while len(encoders) > 1:
            encoders.pop(next(iter(encoders)))
    encoders[key] = encoder
    return encoder


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows of a list column that are encoded together."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + AT_A_TIME, "right")) - 1)
        yield at, min(to, n)
        at = to
