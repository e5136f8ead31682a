"""Polarity bands: a handful of value ranges, closed at both ends."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    category: str
    order: int
    lower: float
    upper: float


def disjoint(bands: Sequence[Band]) -> bool:
    ordered = sorted(bands, key=lambda b: b.lower)
    return all(a.upper < b.lower for a, b in zip(ordered, ordered[1:]))


def gapless(bands: Sequence[Band]) -> list[Band]:
    """Bands stretched to meet, and open at the outer ends (opt-in)."""
    ordered = sorted(bands, key=lambda b: b.lower)
    starts = [float("-inf"), *(b.lower for b in ordered[1:])]
    # The largest double below the next start keeps the ranges disjoint.
    ends = [*(_below(b.lower) for b in ordered[1:]), float("inf")]
    return [Band(b.category, b.order, lo, hi) for b, lo, hi in zip(ordered, starts, ends)]


def _below(value: float) -> float:
    import math

    return math.nextafter(value, -math.inf)


def band_of(value: Column, bands: Sequence[Band]) -> Column:
    """The band a value falls in; NULL in a gap, outside all, or for NULL.

    A plain CASE, so the range lookup needs no join. The bands must not share
    a value; see ``operators.intervals.join_bands`` for a table of bands that may.
    """
    if not disjoint(bands):
        raise ValueError("bands overlap: use join_bands")
    first, *rest = bands
    case = F.when(value.between(first.lower, first.upper), first.category)
    for band in rest:
        case = case.when(value.between(band.lower, band.upper), band.category)
    return case
