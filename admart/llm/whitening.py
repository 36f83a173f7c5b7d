"""Whitening of embeddings by a bidiagonal qd solver.

The centred rows are reduced to a triangle R by blockwise QR: each task folds its rows into one d x d triangle,
triangles are stacked and reduced again until one is left. Householder reflections make R bidiagonal, dqds finds its
singular values to high relative accuracy, and twisted factorisations give the singular vectors. The covariance
itself is never formed, so small components keep their digits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gather, materialize, release

EPS = np.finfo(float).eps
#: Rows that a task adds to its triangle at once.
BLOCK = 4096
LONG = 2**63


# The small matrices: d x d, d being the number of dimensions.

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and V with R = U B V', by Householder reflections from both sides."""
    work, d = r.astype(float).copy(), r.shape[1]
    right = np.eye(d)
    for k in range(d):
        u = reflector(work[k:, k])
        work[k:, k:] -= 2.0 * np.outer(u, u @ work[k:, k:])
        if k < d - 2:
            v = reflector(work[k, k + 1:])
            work[k:, k + 1:] -= 2.0 * np.outer(work[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= 2.0 * np.outer(right[:, k + 1:] @ v, v)
    return np.diag(work).copy(), np.diag(work, 1).copy(), right


def reflector(x: np.ndarray) -> np.ndarray:
    """The unit vector u for which x - 2 u (u.x) has only a first entry."""
    u = x.astype(float).copy()
    size = np.max(np.abs(u), initial=0.0)
    if size == 0.0:
        return np.zeros_like(u)
    u /= size
    u[0] += math.copysign(np.linalg.norm(u), u[0])
    return u / np.linalg.norm(u)


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squared singular values of the bidiagonal with diagonal a and superdiagonal b, falling.

    Works on q = a^2, e = b^2. A transform with shift s gives the qd array of the matrix less s and is thrown away
    when it turns negative; without a shift it never does, and loses no relative accuracy.
    """
    found: list[float] = []
    blocks = [(list(a * a), list(b * b), 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        shift, turns = 0.0, 0
        while q:
            n = len(q)
            if n == 1 or e[-1] <= EPS * EPS * (sigma + q[-1]):
                found.append(sigma + q.pop())
                if e:
                    e.pop()
                shift = 0.0
                continue
            cut = next((k for k in range(n - 1) if e[k] <= EPS * EPS * (sigma + min(q[k], q[k + 1]))), -1)
            if cut >= 0:
                blocks.append((q[cut + 1:], e[cut + 1:], sigma))
                q, e, shift = q[:cut + 1], e[:cut], 0.0
                continue
            made = transform(q, e, shift)
            if made is None:
                shift = 0.25 * shift if shift > EPS * sigma else 0.0
                continue
            q, e, least, inverse = made
            sigma += shift
            # Least of all d bounds the smallest value from above, the sum of 1 / d from below.
            shift = 0.0 if least <= 0.0 else max(1.0 / inverse * (1 - 4 * EPS), 0.0) if shift == 0.0 else 0.9 * least
            if sigma + shift == sigma:
                shift = 0.0
            turns += 1
            if turns > 200 * (n + 10):
                raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(found))[::-1]


def transform(q: list[float], e: list[float], s: float):
    """One differential qd step with shift s: the new q and e, the least d and the sum of 1 / d; None where it fails."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - s
    least, inverse = d, 0.0
    for k in range(n - 1):
        if d < 0.0:
            return None
        inverse += 1.0 / d if d > 0.0 else math.inf
        x = d + e[k]
        new_q[k] = x
        ratio = q[k + 1] / x if x > 0.0 else 0.0
        new_e[k] = e[k] * ratio
        d = d * ratio - s
        least = min(least, d)
    if d < 0.0:
        return None
    new_q[-1] = d
    return new_q, new_e, least, inverse + (1.0 / d if d > 0.0 else math.inf)


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B'B for the eigenvalue ``value``, by a twisted factorisation of B'B - value.

    B'B = L D L' with D = a^2 and L = b / a. The factorisation from the top and the one from the bottom meet where
    the diagonal entry gamma is least; there the vector is 1, and the rest follows by multiplications alone.
    """
    n = len(a)
    tiny = EPS * EPS * max(value, 1e-300)
    dia, low = a * a, b / a[:-1]
    down, up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for k in range(n - 1):
        x = s[k] + dia[k]
        x = x if abs(x) > tiny else math.copysign(tiny, x)
        down[k] = dia[k] * low[k] / x
        s[k + 1] = down[k] * low[k] * s[k] - value
    p[-1] = dia[-1] - value
    for k in range(n - 2, -1, -1):
        x = dia[k] * low[k] * low[k] + p[k + 1]
        x = x if abs(x) > tiny else math.copysign(tiny, x)
        t = dia[k] / x
        up[k] = low[k] * t
        p[k] = p[k + 1] * t - value
    gamma = s + p + value
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.linalg.norm(z)


def singular(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of R, falling, and the right singular vectors (as columns) of the largest k.

    Where the bidiagonal splits, vectors come from one part. Vectors of values that agree to three digits are kept
    orthogonal by Gram-Schmidt, with steps of inverse iteration where little is left.
    """
    a, b, right = bidiagonal(r)
    d, largest = len(a), max(np.max(np.abs(a), initial=0.0), np.max(np.abs(b), initial=0.0))
    if largest == 0.0:
        return np.zeros(d), np.zeros((d, 0))
    b[np.abs(b) <= 8 * EPS * np.minimum(np.abs(a[:-1]), np.abs(a[1:])) + EPS * EPS * largest] = 0.0
    edges = [0, *(np.flatnonzero(b == 0.0) + 1), d]
    found = []
    for lo, hi in zip(edges, edges[1:]):
        found += [(v, lo, hi) for v in dqds(a[lo:hi], b[lo:hi - 1])]
    found.sort(key=lambda x: -x[0])
    values = np.array([x[0] for x in found])
    safe = np.where(np.abs(a) > EPS * EPS * largest, a, EPS * EPS * largest)  # L needs a to divide by
    vectors = np.zeros((d, min(k, d)))
    for i, (value, lo, hi) in enumerate(found[:k]):
        near = [j for j in range(i) if found[j][1] == lo and values[j] - value <= 1e-3 * values[j]]
        z = twisted(safe[lo:hi], b[lo:hi - 1], value)
        left = apart(z, vectors[lo:hi, near])
        if np.linalg.norm(left) < 0.5:  # it lies among those found: draw another start towards the eigenvalue
            left = np.cos(np.arange(hi - lo) * (i + 1.0))
            for _ in range(4):
                left = apart(left, vectors[lo:hi, near])
                left = solve_near(safe[lo:hi], b[lo:hi - 1], value, left / np.linalg.norm(left))
            left = apart(left, vectors[lo:hi, near])
        vectors[lo:hi, i] = left / np.linalg.norm(left)
    return values, right @ vectors


def apart(z: np.ndarray, others: np.ndarray) -> np.ndarray:
    for _ in range(2):
        z = z - others @ (others.T @ z)
    return z


def solve_near(a: np.ndarray, b: np.ndarray, value: float, z: np.ndarray) -> np.ndarray:
    """A step of inverse iteration for B'B at ``value``."""
    full = np.diag(a) + np.diag(b, 1)
    out = np.linalg.solve(full.T @ full - value * (1 + 16 * EPS) * np.eye(len(a)), z)
    return out / np.linalg.norm(out)


# The rows.

def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of packed little-endian longs."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, d)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: longs, or Python integers where longs are too short."""
    most = int(np.max(np.abs(x), initial=0))
    if n * most + max(map(abs, sums), default=0) < LONG:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n as doubles, each from the exact n * x - S."""
    return (deviations(x, n, sums) / n).astype(float)


def squares(rows: np.ndarray) -> list[int]:
    most = float(np.max(np.abs(rows), initial=0))
    if rows.dtype != object and most * most * rows.shape[1] < LONG / 2:
        return (rows * rows).sum(axis=1).tolist()
    return [sum(v * v for v in map(int, row)) for row in rows]


def packed_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    """vec_id and x = floor(scale * c) + offset as packed longs; rows with a null or non-finite part are left out."""
    v = F.col(vector_col).cast("array<double>")
    valid = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    picked = vectors.where(F.coalesce(valid, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            x = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale) + offset
            if np.max(np.abs(x), initial=0.0) >= LONG:
                raise OverflowError("a scaled component does not fit a long")
            data, ends = x.astype("<i8").tobytes(), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)) * 8
            rows = [data[lo:hi] for lo, hi in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["vec_id", "x"])

    return picked.mapInArrow(run, "vec_id long, x binary")


def totals(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows and the exact sum of each dimension."""
    def fold(batches):
        n, sums = 0, [0] * d
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                x = matrix(batch.column(0).slice(lo, BLOCK), d)
                # Halves of 32 bits, so that the sums of a block can't run over.
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                sums = [s + (int(h) << 32) + int(lo_) for s, h, lo_ in zip(sums, high, low)]
                n += len(x)
        return n, sums

    return gather(fit, fold, lambda parts: (sum(p[0] for p in parts), [sum(c) for c in zip(*(p[1] for p in parts))]))


def triangle(fit: DataFrame, d: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred fit list: R'R is n times the covariance."""
    def fold(batches):
        r = np.zeros((0, d))
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                r = np.linalg.qr(np.vstack([r, centred(matrix(batch.column(0).slice(lo, BLOCK), d), n, sums)]), mode="r")
        return r if len(r) else None

    r = gather(fit, fold, lambda parts: np.linalg.qr(np.vstack(parts), mode="r"))
    return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r


def covariance_gap(fit: DataFrame, d: int, n: int, sums: list[int], white: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity, from the rows themselves."""
    k = white.shape[1]

    def moments(y):
        mean = y.mean(axis=0)
        return len(y), mean, (y - mean).T @ (y - mean)

    def merge(parts):
        rows, mean, square = parts[0]
        for m, other, more in parts[1:]:
            apart_by = other - mean
            square = square + more + np.outer(apart_by, apart_by) * (rows * m / (rows + m))
            mean = mean + apart_by * (m / (rows + m))
            rows += m
        return rows, mean, square

    def fold(batches):
        parts = []
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                parts.append(moments(centred(matrix(batch.column(0).slice(lo, BLOCK), d), n, sums) @ white))
            parts = [merge(parts)] if parts else []
        return parts[0] if parts else None

    rows, _, square = gather(fit, fold, merge)
    return float(np.max(np.abs(square / rows - np.eye(k))))


def whiten(vectors: DataFrame, components: int = 16, scale: float = 64.0, offset: int = 1_000_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    x = floor(scale * c) + offset. The model is fitted on each distinct x once (n of them, their covariance over n);
    whitened is the centred x along the component over the root of its eigenvalue, deviation the exact squared
    length of n * x - S. Rows whose vector is null, empty or holds a null or non-finite part are left out; repeated
    rows and rows without vec_id are each returned. Components of no variance (rank below ``components``) have no
    whitened value and are not returned, so a table of one distinct vector gives no rows, as an empty one does. All
    vectors must have one length; a scaled part or a deviation that no long holds is an error. Extra columns are not
    looked at.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    rows = materialize(packed_vectors(vectors, id_col, vector_col, scale, offset), "vectors")
    fit = materialize(rows.select("x").distinct(), "fit")
    sizes = fit.agg(F.min(F.octet_length("x")).alias("least"), F.max(F.octet_length("x")).alias("most")).first()
    if sizes["most"] is None:
        return spark.createDataFrame([], schema)
    if sizes["least"] != sizes["most"]:
        raise ValueError(f"vectors of {sizes['least'] // 8} to {sizes['most'] // 8} dimensions")
    d = sizes["most"] // 8
    n, sums = totals(fit, d)
    values, directions = singular(triangle(fit, d, n, sums), components)
    rank = int(np.sum(values[:components] > (values[0] if len(values) else 0.0) * (8 * EPS * d) ** 2)) if values[0] > 0 else 0
    if not rank:
        release(rows, fit)
        return spark.createDataFrame([], schema)
    white = directions[:, :rank] / np.sqrt(values[:rank] / n)
    gap = covariance_gap(fit, d, n, sums, white)
    release(fit)
    explained = values[:rank] / values.sum()
    # d x 16 doubles at most go to the executors.
    shared = spark.sparkContext.broadcast((n, sums, white, explained, gap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, model, part, error = shared.value
        k = model.shape[1]
        for batch in batches:
            x = matrix(batch.column(1), d)
            off = deviations(x, count, total)
            y = (off / count).astype(float) @ model
            m = len(x)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            far = pa.array(squares(off), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, count, dtype=np.int64)), far,
                pa.array(y.ravel()), pa.array(np.tile(part, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
