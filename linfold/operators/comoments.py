"""Means and co-moments of many pairs of columns from one scan: a blocked state that merges.

Columns are cut into blocks, and the state of a pair of blocks holds, for each pair of columns (a, b) in it and
over the rows where both are present: the number of rows, the means of a and b, and the sums of squares and
products of their deviations. Tasks work on Arrow batches as matrices, so a batch costs a few matrix products
whatever the number of pairs; rows are never copied. States merge by Chan's rule (each is centred before
anything is multiplied, so offsets cost no precision), first inside a task, then all tasks' states of a pair of
blocks; where the states of ``TASKS`` tasks would not fit ``MERGE_BYTES``, ``FAN_IN`` tasks at a time before that.
What crosses a shuffle depends on the columns and the tasks, not on the rows.

A task's states take at most ``STATE_BYTES``; beyond that many pairs, the pairs of blocks are spread over
several scans (some two thousand columns fit in one).

Missing values are NULL and NaN. An infinite value counts as present, and leaves its pairs' sums undefined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import q

BLOCK = 64
STATE_BYTES = 256 << 20
FAN_IN = 256
TASKS, MERGE_BYTES = 100_000, 256 << 20
#: Cells of a batch that are worked on at a time.
CELLS = 1 << 21

_STATE_DDL = "block int, part long, state binary"
_STATE = pa.schema([("block", pa.int32()), ("part", pa.int64()), ("state", pa.binary())])


class Moments:
    """The state of a pair of blocks: shifts of both sides, then n, means, squares (of a, of b) and products.

    Means are kept relative to the shifts, values of the columns themselves: a constant column has deviations of
    exactly zero.
    """

    def __init__(self, shift_a: np.ndarray, shift_b: np.ndarray, cells: np.ndarray):
        self.shift_a, self.shift_b, self.cells = shift_a, shift_b, cells

    @staticmethod
    def empty(rows: int, cols: int) -> "Moments":
        return Moments(np.zeros(rows), np.zeros(cols), np.zeros((6, rows, cols)))

    def dump(self) -> bytes:
        return np.concatenate((self.shift_a, self.shift_b, self.cells.ravel())).tobytes()

    @staticmethod
    def load(data: bytes, rows: int, cols: int) -> "Moments":
        flat = np.frombuffer(data)
        return Moments(flat[:rows].copy(), flat[rows:rows + cols].copy(), flat[rows + cols:].reshape(6, rows, cols).copy())

    def merge(self, other: "Moments") -> "Moments":
        n1, n2 = self.cells[0], other.cells[0]
        some1, some2 = n1 > 0, n2 > 0
        if not some2.any():
            return self
        # A side that has seen nothing of a column takes the other's shift for it.
        shift_a = np.where(some1.any(axis=1), self.shift_a, other.shift_a)
        shift_b = np.where(some1.any(axis=0), self.shift_b, other.shift_b)
        move_a, move_b = (other.shift_a - shift_a)[:, None], (other.shift_b - shift_b)[None, :]
        a2, b2 = np.where(some2, other.cells[1] + move_a, 0), np.where(some2, other.cells[2] + move_b, 0)
        a1, b1 = self.cells[1], self.cells[2]
        n = n1 + n2
        with np.errstate(invalid="ignore", divide="ignore"):
            share = np.where(n > 0, n2 / n, 0.0)
            both = np.where(some1 & some2, n1 * share, 0.0)
        gap_a, gap_b = _gap(a1, a2), _gap(b1, b2)
        gap_a, gap_b = np.where(some1, gap_a, a2), np.where(some1, gap_b, b2)
        cells = np.empty_like(self.cells)
        cells[0] = n
        cells[1] = np.where(some1, a1 + gap_a * share, a2)
        cells[2] = np.where(some1, b1 + gap_b * share, b2)
        cells[3] = self.cells[3] + other.cells[3] + gap_a * gap_a * both
        cells[4] = self.cells[4] + other.cells[4] + gap_b * gap_b * both
        cells[5] = self.cells[5] + other.cells[5] + gap_a * gap_b * both
        return Moments(shift_a, shift_b, cells)


def _gap(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The difference of means, zero where it is rounding: equal means stay equal."""
    gap = two - one
    return np.where(np.abs(gap) <= 1e-13 * (np.abs(one) + np.abs(two)), 0.0, gap)


def _of_batch(xa, pa_, xb, pb, shift_a, shift_b, endless) -> Moments:
    """The state of one batch. ``x``: values less their shift, 0 where missing or infinite; ``p``: present, as 0 or 1."""
    cells = np.empty((6, xa.shape[1], xb.shape[1]))
    rows = len(xa)
    if pa_ is None:
        mean_a, mean_b = xa.mean(axis=0), xb.mean(axis=0)
        ca, cb = xa - mean_a, xb - mean_b
        cells[0] = rows
        cells[1], cells[2] = mean_a[:, None], mean_b[None, :]
        cells[3], cells[4] = (ca * ca).sum(axis=0)[:, None], (cb * cb).sum(axis=0)[None, :]
        cells[5] = ca.T @ cb
    else:
        n_a, n_b = pa_.sum(axis=0), pb.sum(axis=0)
        mean_a, mean_b = xa.sum(axis=0) / np.maximum(n_a, 1), xb.sum(axis=0) / np.maximum(n_b, 1)
        ca, cb = (xa - mean_a) * pa_, (xb - mean_b) * pb
        n = pa_.T @ pb
        sum_a, sum_b = ca.T @ pb, pa_.T @ cb
        sq_a, sq_b = (ca * ca).T @ pb, pa_.T @ (cb * cb)
        m = np.maximum(n, 1)
        cells[0] = n
        cells[1], cells[2] = np.where(n > 0, mean_a[:, None] + sum_a / m, 0), np.where(n > 0, mean_b[None, :] + sum_b / m, 0)
        cells[3], cells[4] = _spread(sq_a, sum_a * sum_a / m), _spread(sq_b, sum_b * sum_b / m)
        cells[5] = np.where((cells[3] > 0) & (cells[4] > 0), ca.T @ cb - sum_a * sum_b / m, 0)
    if endless is not None:
        cells[5][endless] = np.nan
    return Moments(shift_a, shift_b, cells)


def _spread(squares: np.ndarray, of_mean: np.ndarray) -> np.ndarray:
    """Squares about the mean, zero where the difference is rounding."""
    left = squares - of_mean
    return np.where(left <= 1e-12 * squares, 0.0, left)


class Plan:
    """Which pairs of column blocks are summed: ``left`` and ``right`` name the columns, ``blocks`` the pairs."""

    def __init__(self, left: list[str], right: list[str], same: bool, size: int):
        self.left, self.right, self.same = left, right, same
        cut = lambda cols: [list(range(i, min(i + size, len(cols)))) for i in range(0, len(cols), size)]
        a, b = cut(left), cut(right)
        self.blocks = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if not same or i <= j]

    def shape(self, block: int) -> tuple[int, int]:
        a, b = self.blocks[block]
        return len(a), len(b)

    def bytes(self, block: int) -> int:
        rows, cols = self.shape(block)
        return 8 * (6 * rows * cols + rows + cols)

    def scans(self) -> list[list[int]]:
        """Blocks by scan, so that a task's states fit their bound."""
        out, size = [[]], 0
        for i in range(len(self.blocks)):
            cost = self.bytes(i)
            if out[-1] and size + cost > STATE_BYTES:
                out.append([])
                size = 0
            out[-1].append(i)
            size += cost
        return out


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) if batch.num_columns else \
        np.zeros((batch.num_rows, 0))


def _summed(plan: Plan, blocks: list[int], columns: list[str]):
    """Each task's states of these blocks, from batches with ``columns``."""
    at = {c: i for i, c in enumerate(columns)}

    def run(batches):
        shift = np.full(len(columns), np.nan)
        states: dict[int, Moments] = {}
        step = max(1, CELLS // max(1, len(columns)))
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                x = _matrix(batch.slice(begin, step)).astype(np.float64, copy=False)
                present = ~np.isnan(x)
                finite = np.isfinite(x)
                new = np.isnan(shift) & finite.any(axis=0)
                shift[new] = x[finite[:, new].argmax(axis=0), np.flatnonzero(new)]
                base = np.where(np.isnan(shift), 0.0, shift)
                value = np.where(finite, x - base, 0.0) if not finite.all() else x - base
                whole = present.all(axis=0)
                endless = present & ~finite
                some = endless.any()
                for b in blocks:
                    ia, ib = ([at[names[i]] for i in cols] for names, cols in zip((plan.left, plan.right), plan.blocks[b]))
                    gone = None
                    if some:
                        p, e = present.astype(float), endless.astype(float)
                        gone = (e[:, ia].T @ p[:, ib] + p[:, ia].T @ e[:, ib]) > 0
                    full = whole[ia].all() and whole[ib].all()
                    told = _of_batch(value[:, ia], None if full else present[:, ia].astype(float), value[:, ib],
                                     None if full else present[:, ib].astype(float), base[ia], base[ib], gone)
                    # A column's shift may be younger than the state: merging sorts that out.
                    states[b] = states[b].merge(told) if b in states else told
        part = TaskContext.get().partitionId()
        for b, s in states.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([part], pa.int64()),
                                              pa.array([s.dump()], pa.binary())], schema=_STATE)
    return run


def _met(plan: Plan, table: pa.Table, fan: int) -> tuple[int, int, Moments]:
    """One state of all states in a group (in the order of their tasks, so that results do not depend on arrival)."""
    table = table.sort_by("part")
    block = table.column("block")[0].as_py()
    rows, cols = plan.shape(block)
    one = Moments.empty(rows, cols)
    for data in table.column("state").to_pylist():
        if data:
            one = one.merge(Moments.load(data, rows, cols))
    return block, table.column("part")[0].as_py() // fan, one


def co_moments(df: DataFrame, left, right, finish, ddl: str, same: bool = False, block: int | None = None) -> DataFrame:
    """Rows that ``finish(plan, block, state)`` makes (an Arrow table) of each pair of blocks of ``left`` x ``right``.

    ``same``: both lists are one, and each pair of blocks comes once. Every block gives its rows, even of an empty frame.
    """
    plan = Plan(list(left), list(right), same, block or BLOCK)
    spark = df.sparkSession
    states = None
    for blocks in plan.scans():
        columns = list(dict.fromkeys([plan.left[i] for b in blocks for i in plan.blocks[b][0]]
                                     + [plan.right[i] for b in blocks for i in plan.blocks[b][1]]))
        told = df.selectExpr(*[f"CAST({q(c)} AS DOUBLE) AS c{i}" for i, c in enumerate(columns)]) \
            .mapInArrow(_summed(plan, blocks, columns), _STATE_DDL)
        states = told if states is None else states.unionByName(told)
    # One empty state for each block: as many rows as there are pairs of blocks.
    none = spark.range(len(plan.blocks), numPartitions=1).selectExpr("CAST(id AS INT) AS block", "0L AS part", "X'' AS state")
    states = states.unionByName(none)

    def some(table: pa.Table) -> pa.Table:
        b, part, one = _met(plan, table, FAN_IN)
        return pa.table([pa.array([b], pa.int32()), pa.array([part], pa.int64()), pa.array([one.dump()], pa.binary())],
                        schema=_STATE)

    def last(table: pa.Table) -> pa.Table:
        b, _, one = _met(plan, table, 1)
        return finish(plan, b, one)
    if any(plan.bytes(i) * TASKS > MERGE_BYTES for i in range(len(plan.blocks))):  # a matter of the columns alone
        states = states.groupBy("block", F.floor(F.col("part") / FAN_IN).alias("bucket")).applyInArrow(some, _STATE_DDL)
    return states.groupBy("block").applyInArrow(last, ddl)
