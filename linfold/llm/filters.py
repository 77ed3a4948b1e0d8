"""Bloom filters of a table's hashes, of bounded size: tested inside tasks, built by Spark's bitmap aggregates.

A filter has ``PER_KEY`` bits a key, up to a stated bound. Beyond the bound it says "maybe" more often,
which costs work in the exact step that follows it and never a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_KEY = 16
_BUCKET = 1 << 15  # bits in one of Spark's bitmaps
_SECOND = 24  # where a hash's second place begins


def places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each 64-bit hash."""
    h, low = h.view(np.uint64), np.uint64(bits - 1)
    return (h & low).astype(np.int64), ((h >> np.uint64(_SECOND)) & low).astype(np.int64)


class Filter:
    """A Bloom filter with two bits a key."""

    def __init__(self, bits: int, packed: np.ndarray):
        self.bits, self.packed = bits, packed

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        one, two = places(h, self.bits)
        return self._bit(one) & self._bit(two)


def filter_of(df: DataFrame, column: str, n: int, most_bits: int) -> Filter:
    """The filter of ``n`` longs; the driver gets ``most_bits`` bits at most, whatever ``n`` is."""
    bits = _BUCKET
    while bits < min(PER_KEY * n, most_bits):
        bits *= 2
    low = bits - 1
    found = df.select(F.explode(F.array(
        F.col(column).bitwiseAND(F.lit(low).cast("long")),
        F.shiftrightunsigned(F.col(column), _SECOND).bitwiseAND(F.lit(low).cast("long")))).alias("at")) \
        .groupBy((F.shiftright("at", 15)).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("map"))
    packed = np.zeros(bits // 8, dtype=np.uint8)
    for r in found.collect():
        start = r["bucket"] * (_BUCKET // 8)
        packed[start:start + _BUCKET // 8] = np.frombuffer(r["map"], dtype=np.uint8)
    return Filter(bits, packed)
