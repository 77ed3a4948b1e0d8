"""Reproducible row splits.

The source job used ``randomSplit([0.7, 0.3], seed=100)``. That sorts every
partition on all columns and Bernoulli-samples, so the sides move when the input
is re-partitioned (a different executor count, a retried stage with a different
layout). The default here is a predicate on a hash of a row key: no sort, no
shuffle, pushed into the scan stage, and a key always lands on the same side.
``xxhash64`` is the default hash; ``md5`` is the portable one other engines can
reproduce.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import key_hash, q


def cuts(weights) -> list[float]:
    """Upper bounds of the sides as shares; the last is open."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    cuts, acc = [], 0.0
    for w in weights[:-1]:
        acc += w
        cuts.append(acc / total)
    return cuts


def side_of(key, weights=(0.7, 0.3), hash_fn: str = "xxhash64") -> Column:
    """Index of the side a row falls on, from its key alone; NULL keys share a side (that of an empty text)."""
    share = key_hash(key, hash_fn)
    expr = F.lit(0)
    for cut in cuts(list(weights)):
        expr = expr + (share >= F.lit(cut)).cast("int")
    return expr.cast("int")


def hash_split(df: DataFrame, key: str, weights=(0.7, 0.3), hash_fn: str = "xxhash64") -> list[DataFrame]:
    """Split by key hash into ``len(weights)`` disjoint, complete frames (the sides of ``side_of``)."""
    side = side_of(key, weights, hash_fn)
    return [df.filter(side == i) for i in range(len(weights))]


def split(df: DataFrame, key: str | None = None, weights=(0.7, 0.3), seed: int = 100,
          method: str = "hash", hash_fn: str = "xxhash64") -> list[DataFrame]:
    """``hash`` (default, needs a key) or ``random`` (``randomSplit`` parity form)."""
    if method == "hash":
        if key is None:
            raise ValueError("hash split needs a row key")
        return hash_split(df, key, weights, hash_fn=hash_fn)
    if method == "random":
        return df.randomSplit(list(weights), seed=seed)
    raise ValueError(f"unknown split method {method!r}")


def split_summary(df: DataFrame, key: str, label: str | None = None, weights=(0.7, 0.3),
                  hash_fn: str = "xxhash64") -> DataFrame:
    """Rows (and mean label) per side in one pass: (side, n[, mean_label])."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if label is not None:
        aggs.append(F.avg(label).alias("mean_label"))
    return df.groupBy(side_of(key, weights, hash_fn=hash_fn).alias("side")).agg(*aggs)


#: Bits of the hash that one refining histogram looks at.
STEP_BITS = 16


def _bound(rows: DataFrame, bits: int, want: int) -> tuple[int, int, int, bool]:
    """Where the ``want`` least of the whole numbers ``h`` end: (bin, bits below the bin, how many of the bin, all of it)."""
    place, known, before, here = 0, 0, 0, 0
    while known < bits:
        step = min(STEP_BITS, bits - known)
        inside = rows.filter(F.shiftright("h", bits - known) == place) if known else rows
        counts = inside.groupBy(F.shiftright("h", bits - known - step).alias("b")).agg(F.count(F.lit(1)).alias("c"))
        known += step
        for r in counts.orderBy("b").collect():  # a row for each bin
            place, here = r["b"], r["c"]
            if before + here >= want:
                break
            before += here
        if before + here == want:
            break
    return place, bits - known, want - before, before + here == want


def exact_split(df: DataFrame, key: str, share: float = 0.7, hash_fn: str = "xxhash64") -> list[DataFrame]:
    """Two sides of exact size: the first has the round(``share`` * n) rows with the least key hashes (a half rounds up).

    The hash at which the first side ends is found by histograms that get finer: counts by the leading 16 bits, then
    by the next 16 inside the bin where the bound lies, until the bound falls between two bins. Each is one
    aggregate of at most 65,536 groups; no row is sorted or collected. Rows that tie at the bound (equal keys) are
    told apart in the same way by a hash of the whole row, and rows equal in everything are counted out. As
    with ``hash_split``, a row's side depends on the rows' content alone, not on their layout. The bound is read
    when this is called; the sides themselves are filters.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must be from 0 to 1")
    bits = 32 if hash_fn == "md5" else 53
    whole = df.select(F.floor(key_hash(key, hash_fn) * F.lit(2.0 ** bits)).cast("bigint").alias("h"),
                      F.shiftrightunsigned(F.xxhash64(*[q(c) for c in df.columns]), 1).alias("r"), F.struct("*").alias("row"))
    want = int(df.count() * share + 0.5)

    def rows(told: DataFrame) -> DataFrame:
        return told.select("row.*")
    if want == 0:
        return [df.limit(0), df]
    place, rest, left, even = _bound(whole.select("h"), bits, want)
    h = F.shiftright("h", rest)
    if even:
        return [rows(whole.filter(h <= place)), rows(whole.filter(h > place))]
    below, tied, above = whole.filter(h < place), whole.filter(h == place), whole.filter(h > place)
    place2, rest2, left, even = _bound(tied.select(F.col("r").alias("h")), 63, left)
    r = F.shiftright("r", rest2)
    if even:
        return [rows(below.unionByName(tied.filter(r <= place2))), rows(above.unionByName(tied.filter(r > place2)))]
    # Equal rows: the first side takes ``left`` of them, wherever they lie.
    same = tied.filter(r == place2).groupBy("h", "r", "row").agg(F.count(F.lit(1)).alias("c"))

    def repeated(times):
        return same.select("h", "r", "row", F.explode(F.sequence(F.lit(1), times)).alias("_")).drop("_")
    return [rows(below.unionByName(tied.filter(r < place2)).unionByName(repeated(F.lit(left)))),
            rows(above.unionByName(tied.filter(r > place2)).unionByName(repeated((F.col("c") - left).cast("int"))))]
