"""Embedding whitening: vectors on the unit-variance principal axes of the whole table.

Entries become whole numbers, x = floor(64 c) + 1000000, so that sums are exact. Three reductions over the
table, each one small row a task, combined a few at a time:

1. counts and exact sums, which give the mean;
2. *blockwise QR*: every task keeps the triangular factor of its centred rows, block by block, and the factors
   are stacked and factorised again until one is left. R'R is the scatter matrix, but no product of data was
   ever summed, so small variances keep their digits;
3. the covariance of the whitened vectors, which says how far it is from the identity.

The factor R (one row for each dimension) is then taken apart by ``singular``: Householder bidiagonalisation,
dqds for the singular values, twisted factorisations for the directions.

Handling: rows whose vector is null, or holds a null, a NaN, an infinite or an absurd entry (2**46 or beyond,
which has no exact whole number), are left out; so are vectors whose length is not the most common one (of
equally common lengths the smaller). Repeated rows count as often as they come; a null id is kept. Directions
in which nothing varies have no whitened value: such components are left out, so n equal vectors, or one
vector, give no rows. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.singular import right_singular
from linfold.llm.texts import batch_of, settled

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 32
#: Entries from here on are not numbers to work with.
ABSURD = 2.0 ** 46
#: Rows of one QR step, and factors combined in one task.
BLOCK_ROWS, FAN_IN = 4096, 8


def _whole(batch: pa.RecordBatch, dim: int | None):
    """By vector length: (length, rows of the batch, their whole numbers); only lengths equal to ``dim`` if given."""
    column = batch.column(batch.schema.get_field_index("_vec"))
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    value = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    begin = np.concatenate(([0], np.cumsum(np.maximum(size, 0))))[:-1]
    for length in np.unique(size) if dim is None else [dim]:
        rows = np.flatnonzero(size == length)
        if length < 0 or not len(rows):
            continue
        block = value[begin[rows][:, None] + np.arange(length)]
        good = (np.isfinite(block) & (np.abs(np.where(np.isfinite(block), block, 0)) < ABSURD)).all(axis=1)
        if good.any():
            yield int(length), rows[good], np.floor(SCALE * block[good]).astype(np.int64) + SHIFT


_HALF = 26
_SUMS = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])


def _sums(batches):
    """Of every length, the number of vectors and their sums, in two halves that cannot overflow."""
    seen: dict = {}
    for batch in batches:
        for d, _, x in _whole(batch, None):
            new = (len(x), (x >> _HALF).sum(axis=0), (x & ((1 << _HALF) - 1)).sum(axis=0))
            seen[d] = tuple(p + q for p, q in zip(seen[d], new)) if d in seen else new
    if seen:
        yield batch_of(_SUMS, list(seen), [v[0] for v in seen.values()],
                       *[pa.array([v[i] for v in seen.values()], _SUMS[2].type) for i in (1, 2)])


@dataclass
class Whitening:
    """Centre and axes: ``mean`` is ``floor`` + ``rest`` / n exactly; ``axes`` has a column for each component."""

    n: int
    floor: np.ndarray
    rest: np.ndarray
    variances: np.ndarray
    axes: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.axes / np.sqrt(self.variances))

    def deviations(self, x: np.ndarray) -> list:
        """sum((n x - S)**2) of each row; None where it does not fit a long."""
        gap = np.abs(x - self.floor)
        if float(gap.max(initial=0) + 1) ** 2 * float(self.n) ** 2 * max(1, x.shape[1]) < 2.0 ** 62:
            return ((self.n * (x - self.floor) - self.rest) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * (v - f) - r) ** 2 for v, f, r in zip(row, self.floor.tolist(), self.rest.tolist()))
                 for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def _vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    return df.select(F.col(vec_id).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_vec"))


_PART = pa.schema([("part", pa.int64()), ("m", pa.binary())])


def _combined(parts: DataFrame, merge) -> np.ndarray | None:
    """One matrix of the matrices of all tasks: ``FAN_IN`` of them meet in a task, again and again."""
    here = settled(parts.select(F.monotonically_increasing_id().alias("part"), "m"), "parts")
    width = "part long, m binary"
    while (n := here.count()) > 1:
        # Dense numbers from one row a task: as many rows as there were tasks, not vectors.
        numbers = {r["part"]: i for i, r in enumerate(here.select("part").orderBy("part").collect())}
        bucket = F.udf(lambda p: numbers[p] // FAN_IN, "long")

        def met(table: pa.Table) -> pa.Table:
            rows = table.sort_by("part")
            one = None
            for m in rows.column("m").to_pylist():
                m = np.frombuffer(m)
                one = m if one is None else merge(one, m)
            return pa.table({"part": [min(rows.column("part").to_pylist())], "m": [one.tobytes()]}, schema=_PART)

        here = settled(here.withColumn("bucket", bucket("part")).groupBy("bucket").applyInArrow(
            lambda t: met(t.select(["part", "m"])), width).repartition(max(1, n // FAN_IN)), "parts")
    found = here.collect()
    return np.frombuffer(found[0]["m"]).copy() if found else None


def _triangles(centre: Whitening):
    def run(batches):
        d = len(centre.floor)
        r, block, rows = np.zeros((0, d)), [], 0
        for batch in batches:
            for _, _, x in _whole(batch, d):
                block.append(centre.centred(x))
                rows += len(x)
                if rows >= BLOCK_ROWS:
                    r, block, rows = np.linalg.qr(np.vstack([r, *block]), mode="r"), [], 0
        if rows or len(r):
            r = np.linalg.qr(np.vstack([r, *block]), mode="r")
            full = np.zeros((d, d))
            full[:len(r)] = r
            yield batch_of(_PART, [0], [full.tobytes()])
    return run


def fit(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Centre and axes of all vectors; None if there are none."""
    vectors = _vectors(df, vec_id, vector)
    halves = settled(vectors.mapInArrow(_sums, "d int, n long, high array<long>, low array<long>"), "sums")
    sizes = halves.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return None
    d, n = sizes["d"], sizes["n"]
    told = halves.where(F.col("d") == d).select(F.posexplode(F.arrays_zip("high", "low")).alias("dim", "s")) \
        .groupBy("dim").agg(F.sum(F.col("s.high").cast("decimal(38,0)")).alias("high"),
                            F.sum(F.col("s.low").cast("decimal(38,0)")).alias("low")).orderBy("dim").collect()
    sums = [(int(r["high"]) << _HALF) + int(r["low"]) for r in told]
    centre = Whitening(n, np.array([s // n for s in sums], dtype=np.int64), np.array([s % n for s in sums], dtype=np.int64),
                       np.zeros(0), np.zeros((d, 0)), 0.0)
    if d == 0:
        return centre

    def merge(a, b):
        r = np.linalg.qr(np.vstack([a.reshape(d, d), b.reshape(d, d)]), mode="r")
        return r.ravel()

    r = _combined(vectors.mapInArrow(_triangles(centre), "part long, m binary"), merge).reshape(d, d)
    scatter, axes = right_singular(r, components)
    return Whitening(n, centre.floor, centre.rest, scatter / n, axes, float((r * r).sum()) / n)


def identity_error(df: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k, d = model.axes.shape[1], len(model.floor)

    def run(batches):
        # n, mean and co-moments of each block, merged as it goes: centred before anything is multiplied
        state = None
        for batch in batches:
            for _, _, x in _whole(batch, d):
                w = model.whitened(x)
                mean = w.mean(axis=0)
                new = np.concatenate(([len(w)], mean, ((w - mean).T @ (w - mean)).ravel()))
                state = new if state is None else merge(state, new)
        if state is not None:
            yield batch_of(_PART, [0], [state.tobytes()])

    def merge(one, two):
        n1, n2, gap = one[0], two[0], two[1:k + 1] - one[1:k + 1]
        n = n1 + n2
        return np.concatenate(([n], one[1:k + 1] + gap * n2 / n,
                               one[k + 1:] + two[k + 1:] + (np.outer(gap, gap) * n1 * n2 / n).ravel()))

    if not k:
        return 0.0
    state = _combined(_vectors(df, vec_id, vector).mapInArrow(run, "part long, m binary"), merge)
    return float(np.abs(state[k + 1:].reshape(k, k) / state[0] - np.eye(k)).max())


_WHITE = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])


def transform(df: DataFrame, model: Whitening | None, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, deviation, whitened): every remaining row's exact deviation and its place on the axes."""
    ddl = "vec_id long, deviation long, whitened array<double>"
    if model is None:
        return df.sparkSession.createDataFrame([], ddl)

    def run(batches):
        for batch in batches:
            for _, rows, x in _whole(batch, len(model.floor)):
                w = model.whitened(x)
                cut = pa.array(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1])
                yield batch_of(_WHITE, batch.column(0).take(pa.array(rows)), model.deviations(x),
                               pa.ListArray.from_arrays(cut, pa.array(w.ravel())))
    return _vectors(df, vec_id, vector).mapInArrow(run, ddl)


def components(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each remaining row and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    model = fit(df, vec_id, vector, most)
    error = 0.0 if model is None else identity_error(df, model, vec_id, vector)
    shares = [] if model is None else (model.variances / model.total).tolist() if model.total else []
    return transform(df, model, vec_id, vector).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"),
        F.element_at(F.array(*[F.lit(float(x)) for x in shares or [0.0]]), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"))
