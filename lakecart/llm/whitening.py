"""Embedding whitening through blockwise QR and a bidiagonal qd solver.

1. Every entry c becomes the integer x = floor(64 c) + 1,000,000; the fit list
   holds each distinct vector of integers once (n vectors, sums S), counted
   and summed exactly.
2. Blocks of the fit list, centred as (n x - S) / n (the numerator exact, so
   the offset costs no digits), are reduced by QR to one upper triangular R per
   task; the Rs are reduced the same way in rounds of ``FAN`` (the matrix stays
   d x d, so the last R is all that reaches the driver).
3. There Householder reflections turn R into an upper bidiagonal B = U'RV'.
   The qd arrays of B'B (squares of its entries) give the squared singular
   values by dqds sweeps, to high relative accuracy.
4. The right singular vectors of B come from twisted factorisations of
   B'B - lambda (a stationary qd transform from the top, a progressive one from
   the bottom, joined where they leave the smallest residual); vectors of close
   values are made orthogonal; the reflections carry them back.
5. Every row is centred exactly, projected and divided by the root of its
   eigenvalue.  The covariance of the whitened fit list is then summed over all
   of its rows as a check (``identity_error``).

Defined results: rows whose vector is null, empty or holds a null, NaN or
infinite entry are dropped, as are rows with an entry beyond ``LARGEST`` (their
integers would not be exact) and rows of another length than the most frequent
one of the fit list (ties: the longest).  Repeated vectors count once in the
fit and are whitened each; ties (equal eigenvalues) give some orthonormal basis
of their space, the same for all rows.  Directions without variance (relative
to the largest, ``NO_VARIANCE``) cannot be whitened and give no component.  A
null id stays; extra columns are left aside; an empty table or a fit list of
one vector gives no rows.  ``deviation`` is null where it does not fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.llm.storage import materialize

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Entries up to this size become exact integers whose sums over any table stay exact.
LARGEST = 1e12
#: Eigenvalues below this part of the largest one count as no variance.
NO_VARIANCE = 1e-13
#: Triangles that one task reduces to one.
FAN = 32
# Rows of a block in a task.
ROWS = 4096


def grid(vector: Column) -> Column:
    """The integers of a vector; null where it is unusable."""
    entry = lambda c: c.cast("double")
    bad = F.exists(vector, lambda c: F.coalesce(F.isnan(entry(c)) | (F.abs(entry(c)) > LARGEST), F.lit(True)))
    usable = vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))
    return F.when(usable, F.transform(vector, lambda c: F.floor(entry(c) * SCALE).cast("bigint") + OFFSET))


def fit_list(rows: DataFrame, vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(x) of every distinct usable vector of the table's dimension, written; and the dimension (0 for an empty table)."""
    distinct = materialize(rows.select(grid(F.col(vector_col)).alias("x")).filter("x is not null").distinct(), "whitening-fit")
    sizes = distinct.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    d = top["d"] if top else 0
    return distinct.filter(F.size("x") == d), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of an Arrow list column as an integer matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """n and the exact sums of each dimension (Python integers)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for b in batches:
            for a in range(0, b.num_rows, ROWS):
                x = _matrix(b.column(0).slice(a, ROWS), d)
                n += len(x)
                # Two halves, so that no partial sum of ROWS entries overflows.
                high, low = x >> 20, x & ((1 << 20) - 1)
                total = [t + (int(h) << 20) + int(v) for t, h, v in zip(total, high.sum(0), low.sum(0))]
        if n:
            yield pa.RecordBatch.from_pydict({"dim": [-1, *range(d)], "total": [str(n), *map(str, total)]},
                                             schema=pa.schema([("dim", pa.int32()), ("total", pa.string())]))

    parts = fit.mapInArrow(partial, "dim int, total string")
    rows = parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # d + 1 rows
    of = {r["dim"]: int(r["total"]) for r in rows}
    return of.get(-1, 0), [of.get(i, 0) for i in range(d)]


def _lifted(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: long integers where they cannot overflow, else Python's."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if most < 1 << 61:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n in double precision."""
    return (_lifted(x, n, sums) / n).astype(float)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sum of (n x - S)^2 of each row."""
    lifted = _lifted(x, n, sums)
    if lifted.dtype != object and lifted.size and int(np.abs(lifted).max()) ** 2 * x.shape[1] < 1 << 62:
        return (lifted * lifted).sum(1).tolist()
    total = [sum(int(v) ** 2 for v in row) for row in lifted]
    return [t if t < 1 << 63 else None for t in total]


def _triangle(blocks: Iterator[np.ndarray], d: int) -> np.ndarray:
    r = np.zeros((0, d))
    for block in blocks:
        r = np.linalg.qr(np.vstack([r, block]), mode="r")
    return r


def triangle(fit: DataFrame, d: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred fit list: one triangle per task, then rounds of ``FAN`` to one."""
    schema = "part int, i int, row array<double>"
    arrow = pa.schema([("part", pa.int32()), ("i", pa.int32()), ("row", pa.list_(pa.float64()))])

    def batch(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": [part] * len(r), "i": list(range(len(r))), "row": list(r)}, schema=arrow)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pieces = (centred(_matrix(b.column(0).slice(a, ROWS), d), n, sums) for b in batches for a in range(0, b.num_rows, ROWS))
        r = _triangle(pieces, d)
        if len(r):
            yield batch(TaskContext.get().partitionId(), r)

    def reduce(key, table):
        rows = _matrix(table.column("row"), d)
        return pa.Table.from_batches([batch(key[0].as_py(), _triangle((rows[a:a + ROWS] for a in range(0, len(rows), ROWS)), d))])

    now = materialize(fit.mapInArrow(first, schema), "whitening-triangles")
    parts = (now.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        # FAN triangles of d x d are what one task holds.
        merged = now.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("part").applyInArrow(reduce, schema)
        now, parts = materialize(merged, "whitening-triangles"), math.ceil(parts / FAN)
    return np.array([r["row"] for r in now.orderBy("i").collect()], float).reshape(-1, d)  # at most d rows


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B = U' R V, and V, by Householder reflections from both sides."""
    d = r.shape[1]
    a = np.zeros((d, d))
    a[:len(r)] = r
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray:
        h = x.copy()
        h[0] += math.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(h)
        return h / size if size else h

    for k in range(d):
        h = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(h, h @ a[k:, k:])
        if k < d - 2:
            h = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ h, h)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ h, h)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues (falling) of B'B from the squares of B's diagonal and superdiagonal.

    Sweeps of the differential qd transform with a shift below the smallest
    eigenvalue; a shift that turns out too large is halved and the sweep done again.
    """
    tiny, out = np.finfo(float).eps ** 2, []
    stack = [(list(map(float, q)), list(map(float, e)), 0.0)]
    while stack:
        q, e, sigma = stack.pop()
        shift, tries = 0.0, 0
        while q:
            m = len(q)
            if m == 1:
                out.append(q[0] + sigma)
                break
            # Negligible couplings cut the array; the values of the parts are its own.
            cut = next((i for i in range(m - 2, -1, -1) if e[i] <= tiny * (sigma + min(q[i] + e[i], q[i + 1]) or q[i]) or e[i] == 0.0), -1)
            if cut >= 0:
                stack.append((q[:cut + 1], e[:cut], sigma))
                q, e, shift, tries = q[cut + 1:], e[cut + 1:], 0.0, 0
                continue
            if q[-1] > q[0] * 1.5 and tries == 0:  # graded the wrong way round
                q, e = _flipped(q, e)
            done = _sweep(q, e, shift)
            while done is None:
                shift = shift / 2 if shift > tiny * (sigma + max(q)) else 0.0
                done = _sweep(q, e, shift)
            q, e, least = done
            sigma += shift
            tries += 1
            # The smallest d of a sweep bounds the smallest eigenvalue from above; below it by the couplings around its place.
            near = max(e[-1], e[-2] if m > 2 else 0.0)
            shift = max(0.0, least - math.sqrt(max(0.0, near * (least + near)))) if tries > 1 else 0.0
    return np.sort(np.array(out))[::-1]


def _flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The same eigenvalues from the other end: B'B and BB' reversed are similar."""
    return q[::-1], e[::-1]


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform; None if the shift was above the smallest eigenvalue."""
    d = q[0] - shift
    least, new_q, new_e = d, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        if top == 0.0:  # a zero value: nothing couples
            new_q.append(0.0), new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / top
            new_q.append(top), new_e.append(e[i] * ratio)
            d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    return [*new_q, d], new_e, max(0.0, least)


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit vector z with B'B z = value z, by the twisted factorisation with the smallest residual."""
    m, q, e = len(a), a * a, b * b
    floor = np.finfo(float).eps ** 2 * (q.max() + e.max(initial=0.0))  # stands in for a pivot of zero
    s, down = np.empty(m), np.empty(max(m - 1, 0))  # stationary, from the top: L D L' = L+ D+ L+'
    s[0] = -value
    for i in range(m - 1):
        pivot = q[i] + s[i] if abs(q[i] + s[i]) > floor else floor
        down[i] = a[i] * b[i] / pivot
        s[i + 1] = e[i] / pivot * s[i] - value
    p, up = np.empty(m), np.empty(max(m - 1, 0))  # progressive, from the bottom
    p[-1] = q[-1] - value
    for i in range(m - 2, -1, -1):
        pivot = e[i] + p[i + 1] if abs(e[i] + p[i + 1]) > floor else floor
        up[i] = a[i] * b[i] / pivot
        p[i] = q[i] / pivot * p[i + 1] - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(m)
    z[k] = 1.0
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(k - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(k, m - 1):
            z[i + 1] = -up[i] * z[i]
    z[~np.isfinite(z)] = 0.0
    return z / np.linalg.norm(z)


def singular_pairs(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of R'R and their unit vectors (columns)."""
    a, b, v = bidiagonalise(r)
    d, size = len(a), max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if not size:
        return np.zeros(0), np.zeros((d, 0))
    # Where B falls apart, its parts have vectors of their own.
    cuts = [0, *(i + 1 for i in range(d - 1) if abs(b[i]) <= np.finfo(float).eps * size), d]
    found = []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        part_a, part_b = a[lo:hi], b[lo:hi - 1]
        found += [(value, lo, hi) for value in dqds(part_a ** 2, part_b ** 2)]
    found = sorted(found, key=lambda f: -f[0])[:k]
    values = np.array([f[0] for f in found])
    z = np.zeros((d, len(found)))
    for c, (value, lo, hi) in enumerate(found):
        z[lo:hi, c] = twisted_vector(a[lo:hi], b[lo:hi - 1], value)
        # Vectors of close values are only accurate together: orthogonal to those before, twice.
        close = [i for i in range(c) if found[i][1] == lo and values[i] - value <= 1e-3 * values[i]]
        for _ in range(2):
            z[:, c] -= z[:, close] @ (z[:, close].T @ z[:, c])
            z[:, c] /= np.linalg.norm(z[:, c]) or 1.0
        if not _residual(a, b, value, z[:, c]) <= 1e-13 * d * values[0]:
            # No new direction was left of it (or a pivot vanished): another start, refined towards the value.
            z[:, c] = 0.0
            z[lo:hi, c] = _refined(a[lo:hi], b[lo:hi - 1], value, z[lo:hi, close])
    return values, v @ z


def _residual(a: np.ndarray, b: np.ndarray, value: float, z: np.ndarray) -> float:
    """Norm of B'B z - value z."""
    y = a * z
    y[:-1] += b * z[1:]
    out = a * y - value * z
    out[1:] += b * y[:-1]
    return float(np.linalg.norm(out))


def _refined(a: np.ndarray, b: np.ndarray, value: float, others: np.ndarray) -> np.ndarray:
    """Inverse iteration with B'B - value, kept orthogonal to the others."""
    bidiagonal = np.diag(a) + np.diag(b, 1)
    gram = bidiagonal.T @ bidiagonal
    shifted = gram - (value + 1e-14 * max(value, gram.diagonal().max())) * np.eye(len(a))
    z = np.cos(np.arange(len(a)) * (others.shape[1] + 1.0))
    for _ in range(5):
        for _ in range(2):
            z -= others @ (others.T @ z)
            z /= np.linalg.norm(z)
        z = np.linalg.solve(shifted, z)
    for _ in range(2):
        z -= others @ (others.T @ z)
        z /= np.linalg.norm(z)
    return z


@dataclass
class Whitening:
    """What whitens a row: n, the sums, eigenvalues of the covariance, unit directions (columns) and the trace."""

    dim: int
    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.directions / np.sqrt(self.values)


def fit(vectors: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list; None where nothing varies."""
    if not d:
        return None
    n, sums = _sums(vectors, d)
    r = triangle(vectors, d, n, sums)
    values, directions = singular_pairs(r, min(components, d))
    keep = values > NO_VARIANCE * values[0] if len(values) else np.zeros(0, bool)
    if not keep.any():
        return None
    return Whitening(d, n, sums, values[keep] / n, directions[:, keep], float((r * r).sum()) / n)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance (centred) minus the identity."""
    k = len(model.values)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))  # sums, then sums of products
        for b in batches:
            for a in range(0, b.num_rows, ROWS):
                w = model.project(_matrix(b.column(0).slice(a, ROWS), model.dim))
                total[0] += w.sum(0)
                total[1:] += w.T @ w
        yield pa.RecordBatch.from_pydict({"at": list(range(total.size)), "v": total.ravel()},
                                         schema=pa.schema([("at", pa.int32()), ("v", pa.float64())]))

    # (k + 1) k rows
    rows = vectors.mapInArrow(partial, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((k + 1) * k)
    for r in rows:
        total[r["at"]] = r["v"]
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row: id, ``deviation`` and ``whitened`` (one entry per component)."""
    kept = rows.select(F.col(id_col).alias("id"), grid(F.col(vector_col)).alias("x"))
    kept = kept.filter(F.col("x").isNotNull() & (F.size("x") == (model.dim if model else -1)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, ROWS):
                ids, x = b.column(0).slice(a, ROWS), _matrix(b.column(1).slice(a, ROWS), model.dim)
                w = model.project(x)
                offsets = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(deviations(x, model.n, model.sums), pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))], names=["id", "deviation", "whitened"])

    kind = rows.schema[id_col].dataType.simpleString()
    return kept.mapInArrow(apply, f"id {kind}, deviation bigint, whitened array<double>").withColumnRenamed("id", id_col)


def components(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened, explained, identity_error."""
    vectors, d = fit_list(rows, vector_col)
    model = fit(vectors, d, k)
    error = identity_error(vectors, model) if model else 0.0
    shares = [float(v / model.trace) for v in model.values] if model else [0.0]
    explained = F.array(*map(F.lit, shares))
    return (whiten(rows, model, id_col, vector_col)
            .select(id_col, "deviation", F.posexplode("whitened").alias("i", "whitened"))
            .select(id_col, (F.col("i") + 1).alias("component"), F.lit(model.n if model else 0).cast("bigint").alias("n"),
                    "deviation", "whitened", F.get(explained, F.col("i")).alias("explained"),
                    F.lit(error).alias("identity_error")))
