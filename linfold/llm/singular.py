"""Singular values and right singular vectors of a small square matrix, by bidiagonal qd iterations.

1. ``bidiagonal``: Householder reflections from both sides bring R to upper bidiagonal form B (diagonal a,
   superdiagonal b), R = U B V'.
2. ``qd_values``: the differential qd algorithm with shifts (dqds) on q = a**2, e = b**2. It never subtracts
   anything but the shift, so even the smallest eigenvalues of B'B come out to nearly full relative precision.
   A shift that is too large shows as a negative pivot and is retried smaller; a zero shift always succeeds.
3. ``twisted_vector``: B'B - x is factorised from the top (stationary qd) and from the bottom (progressive qd);
   where the two meet with the least pivot, one back-substitution in each direction gives the eigenvector.
   Vectors of values that lie very close together are made orthogonal to each other, by inverse iteration
   where twisted factorisations cannot tell them apart.

The matrix has one row for each dimension of the embeddings, whatever the number of embeddings.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Values closer than this, relative to the larger one, are orthogonalised against each other.
CLOSE = 1e-3


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, V): R = U B V' with B upper bidiagonal."""
    r = np.array(r, dtype=float)
    n = len(r)
    right = np.eye(n)
    for k in range(n):
        _reflect(r[k:, k:], None)
        if k < n - 2:
            _reflect(r[k:, k + 1:].T, right[:, k + 1:])
    return np.diag(r).copy(), np.diag(r, 1).copy(), right


def _reflect(block: np.ndarray, keep: np.ndarray | None) -> None:
    """Clears the first column of ``block`` below its top, in place; ``keep`` gathers the reflections."""
    x = block[:, 0]
    size = np.abs(x).max(initial=0.0)
    if size == 0 or len(x) < 2 or not np.abs(x[1:]).max():
        return
    v = x / size
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    v /= np.linalg.norm(v)
    block -= 2 * np.outer(v, v @ block)
    block[1:, 0] = 0.0
    if keep is not None:
        keep -= 2 * np.outer(keep @ v, v)


def _step(q: list, e: list, shift: float) -> tuple[list, list, float, int]:
    """One dqds transform: (q, e, least pivot, where); a negative pivot means that the shift was too large."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least, where = d, 0
    for k in range(n - 1):
        top = d + e[k]
        new_q[k] = top
        if top > 0:
            t = q[k + 1] / top
            new_e[k] = e[k] * t
            d = d * t - shift
        elif top == 0:  # both are zero: the matrix falls apart here
            d = q[k + 1] - shift
        else:
            return new_q, new_e, top, k
        if d < least:
            least, where = d, k + 1
    new_q[-1] = d
    return new_q, new_e, least, where


def qd_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B (squared singular values), largest first."""
    out: list[float] = []
    work = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    while work:
        q, e, moved = work.pop()
        shift, tries = 0.0, 0
        while q:
            n = len(q)
            if n == 1:
                out.append(max(q[0] + moved, 0.0))
                break
            if e[-1] <= (EPS ** 2) * (moved + q[-1]):
                out.append(max(q[-1] + moved, 0.0))
                q, e, shift = q[:-1], e[:-1], 0.0
                continue
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= (EPS ** 2) * moved or e[k] == 0), None)
            if cut is not None:
                work.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1]:  # the small end goes last, where values are found
                q, e = q[::-1], e[::-1]
            new_q, new_e, least, where = _step(q, e, shift)
            tries += 1
            if least < 0:
                # A failure at the very end tells by how much; elsewhere be careful.
                shift = max(shift + least, 0.0) * (1 - 4 * EPS) if where == n - 1 and tries < 3 else shift / 4
                if tries > 12:
                    shift = 0.0
                continue
            q, e, moved, tries = new_q, new_e, moved + shift, 0
            # The least pivot is above the least eigenvalue; what couples the last row says by how much.
            couple = e[-1] * q[-1] / max(q[-2] - q[-1], e[-1] + q[-1], np.finfo(float).tiny)
            shift = max(least - couple, 0.0) * 0.999 if where == n - 1 else max(least, 0.0) * 0.5
    return np.sort(np.array(out))[::-1]


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B'B at ``value`` by a twisted factorisation."""
    n = len(a)
    if n == 1:
        return np.ones(1)
    tiny = np.finfo(float).tiny / EPS
    q, low = a * a, b / a[:-1]
    down, up = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for k in range(n - 1):
        pivot = q[k] + s[k]
        pivot = pivot if abs(pivot) > tiny else -tiny
        down[k] = q[k] * low[k] / pivot
        s[k + 1] = down[k] * low[k] * s[k] - value
    p[-1] = q[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = q[k] * low[k] ** 2 + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        t = q[k] / pivot
        up[k] = low[k] * t
        p[k] = p[k + 1] * t - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of B'B, a column for each value (values fall)."""
    n = len(a)
    out = np.zeros((n, len(values)))
    dense, begin = None, 0
    for j, x in enumerate(values):
        if j and values[j - 1] - x > CLOSE * values[j - 1]:
            begin = j
        z = twisted_vector(a, b, x)
        near = out[:, begin:j]
        left = z - near @ (near.T @ z)
        if np.linalg.norm(left) < 0.7:  # the same direction again
            if dense is None:
                dense = np.diag(a * a + np.concatenate(([0.0], b * b))) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
            shifted = dense - (x + 4 * EPS * values[0] * (j - begin + 1)) * np.eye(n)
            left = np.cos(np.arange(1, n + 1) * (j + 1.0))
            for _ in range(3):
                left -= near @ (near.T @ left)
                left = np.linalg.solve(shifted, left / np.linalg.norm(left))
                left /= np.linalg.norm(left)
        left -= near @ (near.T @ left)
        out[:, j] = left / np.linalg.norm(left)
    return out


def right_singular(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the largest squared singular values of R, at most ``most`` of those that are not zero to
    rounding, and their unit right singular vectors as columns."""
    a, b, right = bidiagonal(r)
    size = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if size == 0:
        return np.zeros(0), np.zeros((len(a), 0))
    a, b = a / size, b / size
    # A zero on the diagonal is a zero singular value to rounding, wherever it ends up.
    a = np.where(np.abs(a) < EPS ** 2, EPS ** 2, a)
    edges = np.flatnonzero(np.abs(b) <= EPS * EPS) + 1
    values, columns = [], []
    for s, t in zip([0, *edges], [*edges, len(a)]):
        x = qd_values(a[s:t], b[s:t - 1])
        values.append(x)
        columns += [(s, t, i) for i in range(len(x))]
    flat = np.concatenate(values)
    order = np.argsort(-flat, kind="stable")
    order = order[flat[order] > (len(a) * EPS) ** 2 * flat.max()][:most]
    out = np.zeros((len(a), len(order)))
    for s, t in zip([0, *edges], [*edges, len(a)]):
        mine = [j for j, k in enumerate(order) if columns[k][0] == s]
        if mine:
            out[s:t, mine] = _vectors(a[s:t], b[s:t - 1], flat[order[mine]])
    return flat[order] * size ** 2, right @ out
