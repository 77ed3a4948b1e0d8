"""Sums that suffice for least squares with a penalty: one scan, then only small matrices.

A state holds the number of rows, the means and the co-moments of all features and the label (last). Tasks sum
Arrow batches as matrix products; states merge by Chan's rule, so that offsets cost no precision. From the state
of the rows to fit, coordinate descent solves every point of an elastic-net grid, each from where its neighbour
ended; from the state of other rows, a solution's squared error on them follows without reading them again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks whose states meet at a time, where those of ``TASKS`` tasks would not fit ``MERGE_BYTES``.
FAN_IN, TASKS, MERGE_BYTES = 64, 100_000, 256 << 20
_DDL = "side int, part long, state binary"
_SCHEMA = pa.schema([("side", pa.int32()), ("part", pa.int64()), ("state", pa.binary())])
#: A solution's conditions hold to this (for standardised columns); sweeps of a round, and rounds at most.
TOLERANCE, SWEEPS, ROUNDS = 1e-12, 10, 500


@dataclass
class Sums:
    n: float
    mean: np.ndarray
    moments: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> "Sums":
        first = x[0].copy()  # deviations from a value of the column: exactly zero where it is constant
        y = x - first
        mean = y.mean(axis=0)
        y -= mean
        return Sums(float(len(x)), first + mean, y.T @ y)

    def merge(self, other: "Sums") -> "Sums":
        n = self.n + other.n
        gap = other.mean - self.mean
        return Sums(n, self.mean + gap * (other.n / n), self.moments + other.moments
                    + np.outer(gap, gap) * (self.n * other.n / n))

    def dump(self) -> bytes:
        return np.concatenate(([self.n], self.mean, self.moments.ravel())).tobytes()

    @staticmethod
    def load(data: bytes) -> "Sums":
        flat = np.frombuffer(data)
        k = round((1 + 4 * (len(flat) - 1)) ** 0.5 - 1) // 2
        return Sums(float(flat[0]), flat[1:k + 1].copy(), flat[k + 1:].reshape(k, k).copy())


def _rows(told: dict, part: int) -> pa.Table:
    return pa.table([pa.array(list(told), pa.int32()), pa.array([part] * len(told), pa.int64()),
                     pa.array([s.dump() for s in told.values()], pa.binary())], schema=_SCHEMA)


def _task(batches):
    told: dict[int, Sums] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        side, label, features = (batch.column(i) for i in range(3))
        y = label.to_numpy(zero_copy_only=False)
        x = features.flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        if np.isnan(y).any():
            raise ValueError("a label is missing")
        side = side.to_numpy(zero_copy_only=False)
        for s in np.unique(side):
            mine = Sums.of(np.column_stack((x[side == s], y[side == s])))
            told[int(s)] = told[int(s)].merge(mine) if int(s) in told else mine
    if told:
        yield from _rows(told, TaskContext.get().partitionId()).to_batches()


def _met(table: pa.Table) -> pa.Table:
    table = table.sort_by("part")
    one = None
    for data in table.column("state").to_pylist():
        one = Sums.load(data) if one is None else one.merge(Sums.load(data))
    return _rows({table.column("side")[0].as_py(): one}, table.column("part")[0].as_py() // FAN_IN)


def sums(rows: DataFrame, label: str, width: int) -> dict[int, Sums]:
    """The state of each ``_side`` of rows (label, features, _side); nothing else reaches the driver."""
    told = rows.select("_side", F.col(label).cast("double"), vector_to_array("features")).mapInArrow(_task, _DDL)
    size = 8 * TASKS * (width + 1) * (width + 2)
    while size > MERGE_BYTES:  # a matter of the features alone
        told = told.groupBy("side", F.floor(F.col("part") / FAN_IN).alias("bucket")).applyInArrow(_met, _DDL)
        size //= FAN_IN
    return {r["side"]: Sums.load(r["state"]) for r in told.groupBy("side").applyInArrow(_met, _DDL).collect()}


@dataclass
class Solution:
    coefficients: np.ndarray
    intercept: float


def elastic_net_path(state: Sums, points) -> list[Solution]:
    """The elastic net of each (penalty, share of the absolute penalty), in the order of ``points``.

    Features and label are standardised by their population deviation, the penalty is divided by the label's;
    a feature that does not vary has coefficient 0.
    """
    k = len(state.mean) - 1
    spread = np.sqrt(np.maximum(np.diag(state.moments), 0) / state.n)
    varies = np.flatnonzero(spread[:k] > 0)
    flat = Solution(np.zeros(k), float(state.mean[k]))
    if spread[k] == 0 or not len(varies):
        return [flat for _ in points]
    scale = spread[varies]
    r = state.moments[np.ix_(varies, varies)] / state.n / np.outer(scale, scale)
    rho = state.moments[varies, k] / state.n / scale / spread[k]
    found: dict = {}
    start: dict = {}
    for reg, share in sorted(set(points), key=lambda p: (p[1], -p[0])):
        l1, l2 = share * reg / spread[k], (1 - share) * reg / spread[k]
        if l1 == 0:
            ridge = r + l2 * np.eye(len(varies))
            w = np.linalg.solve(ridge, rho) if l2 > 0 else np.linalg.lstsq(ridge, rho, rcond=None)[0]
        else:
            w = _descend(r, rho, l1, l2, start.get(share, np.zeros(len(varies))))
            start[share] = w
        coefficients = np.zeros(k)
        coefficients[varies] = w * spread[k] / scale
        found[reg, share] = Solution(coefficients, float(state.mean[k] - coefficients @ state.mean[:k]))
    return [found[p] for p in points]


def _descend(r: np.ndarray, rho: np.ndarray, l1: float, l2: float, start: np.ndarray) -> np.ndarray:
    """The least of 0.5 w'Rw - rho'w + l1 |w| + 0.5 l2 w'w.

    Rounds of coordinate descent find which coefficients are not zero; with those and their signs given, the rest
    is a linear system. Descent alone would creep where features depend on each other (one-hot columns do).
    """
    w = start.copy()
    for _ in range(ROUNDS):
        left = rho - r @ w
        most = 0.0
        for _ in range(SWEEPS):
            for j in range(len(w)):
                pull = left[j] + r[j, j] * w[j]
                new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (r[j, j] + l2)
                if new != w[j]:
                    left -= r[:, j] * (new - w[j])
                    most = max(most, abs(new - w[j]))
                    w[j] = new
        w = _settle(r, rho, l1, l2, w)
        left = rho - r @ w - l2 * w
        zero = w == 0
        if most <= TOLERANCE or (np.abs(left[zero]) <= l1 + TOLERANCE).all() \
                and (np.abs(left[~zero] - l1 * np.sign(w[~zero])) <= TOLERANCE).all():
            break
    return w


def _settle(r: np.ndarray, rho: np.ndarray, l1: float, l2: float, w: np.ndarray) -> np.ndarray:
    """The least among coefficients with the signs of ``w``: straight towards the solution of the linear system,
    stopping where a coefficient reaches zero, which then stays there. Where dependent features leave the system
    without a solution, the way goes along what is left over, which lowers the penalty at no other cost."""
    w = w.copy()
    while (on := np.flatnonzero(w)).size:
        system = r[np.ix_(on, on)] + l2 * np.eye(len(on))
        want = rho[on] - l1 * np.sign(w[on])
        aim = np.linalg.lstsq(system, want, rcond=1e-11)[0]
        over = want - system @ aim
        way = over if np.abs(over).max() > 1e-9 else aim - w[on]
        falling = np.flatnonzero(way * np.sign(w[on]) < 0)
        steps = -w[on][falling] / way[falling]
        if way is not over and (not len(falling) or steps.min() > 1):
            w[on] = aim
            return w
        if not len(falling):
            return w
        w[on] += steps.min() * way
        w[on[falling[steps == steps.min()]]] = 0.0
    return w


def score(state: Sums, solution: Solution, metric: str) -> float:
    """mse, rmse or r2 of a solution on the rows of a state."""
    k = len(state.mean) - 1
    w = np.append(-solution.coefficients, 1.0)  # error = w . (x, y) - intercept
    bias = w @ state.mean - solution.intercept
    mse = max(float(w @ state.moments @ w) / state.n + bias * bias, 0.0)
    if metric == "r2":
        var = state.moments[k, k] / state.n
        return float(1 - mse / var) if var else float("-inf")
    return float({"mse": mse, "rmse": mse ** 0.5}[metric])
