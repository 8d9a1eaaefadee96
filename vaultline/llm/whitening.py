"""Embedding whitening: leading principal components by spectrum slicing.

1. Entries become integers (``vectors.scaled``); the rows are written once.
2. The fit list holds each distinct vector once (one shuffle, copies combined
   map-side).  Per-dimension sums, and then products of vectors centred on the
   rounded mean, are summed per task as exact integers and added up in Spark as
   decimals: only d(d+3)/2 + 1 sums reach the driver, whatever the input.  The
   covariance is the exact rational rounded once to double.
3. ``leading`` finds the eigenpairs.  The inertia of the LDL' factorisation of
   V - s*I counts the eigenvalues above s (Sylvester); bisection by these counts
   isolates the j-th eigenvalue, Rayleigh quotient iteration converges to it
   inside its interval, and counts just below and above it certify that it
   is number j.
4. Every row is centred, projected and divided by the eigenvalue's root; the
   covariance of the whitened fit list is measured in Spark.

Edge cases: rows with a NULL vector, or NULL, NaN or infinite entries are
dropped; rows with a NULL id are kept; repeated rows are rows of their own
(the fit list has their vector once).  Shorter vectors count as filled up with
zeros to the longest one.  Components without variance (at most ``FLAT`` of the
trace) cannot be whitened and are left out, so an empty table, a single
distinct vector or empty vectors give no rows, and fewer than four
dimensions at most that many components.  Tied eigenvalues give some orthonormal basis
of their space.  A ``deviation`` beyond a long is NULL, ``deviation_exact`` has
it in any case.  Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import table, written
from vaultline.llm.vectors import exact_products, list_array, matrix, scaled

COMPONENTS = 4
#: Variance shares that rounding errors of the covariance could make up.
FLAT = 1e-12
#: Sums within a task are sent on before they could pass a long.
ROOM = 2.0**62

SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double, deviation_exact decimal(38,0)")


# --- spectrum slicing -----------------------------------------------------


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """(negative, zero, positive) eigenvalues of a symmetric matrix, from the
    pivots of its LDL' factorisation (blocks of one or two, chosen so that
    the multipliers stay bounded)."""
    a = np.array(a, dtype=np.float64)
    n, k, negative, zero = len(a), 0, 0, 0
    bound = (1 + 17**0.5) / 8
    while k < n:
        below = np.abs(a[k + 1 :, k])
        most = below.max(initial=0.0)
        if most == 0.0:
            negative += a[k, k] < 0
            zero += a[k, k] == 0
            k += 1
            continue
        wide = False
        if abs(a[k, k]) < bound * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            if abs(a[k, k]) * row.max() < bound * most * most:
                wide = abs(a[r, r]) < bound * row.max()
                to = k + 1 if wide else k
                if to != r:
                    a[[to, r], k:] = a[[r, to], k:]
                    a[k:, [to, r]] = a[k:, [r, to]]
        size = 2 if wide else 1
        block, side = a[k : k + size, k : k + size], a[k + size :, k : k + size]
        if wide:
            det = block[0, 0] * block[1, 1] - block[0, 1] ** 2
            negative += 1 if det < 0 else 2 * (block[0, 0] + block[1, 1] < 0)
            a[k + 2 :, k + 2 :] -= side @ np.linalg.solve(block, side.T)
        else:
            negative += block[0, 0] < 0
            a[k + 1 :, k + 1 :] -= np.outer(side[:, 0] / block[0, 0], side[:, 0])
        k += size
    return int(negative), int(zero), int(n - negative - zero)


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``v`` lie above ``shift``."""
    return inertia(v - shift * np.eye(len(v)))[2]


def _solved(v: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """(v - shift*I)^-1 right, of unit length; a singular shift is moved."""
    while True:
        try:
            x = np.linalg.solve(v - shift * np.eye(len(v)), right)
            norm = np.linalg.norm(x)
            if np.isfinite(norm) and norm > 0:
                return x / norm
        except np.linalg.LinAlgError:
            pass
        shift += tiny
        tiny *= 2


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``v`` (falling) and their unit vectors
    as columns; every pair is certified by counts on both sides."""
    d = len(v)
    scale = float(np.abs(v).sum(axis=1).max(initial=0.0))  # no eigenvalue is larger in size
    if scale == 0.0:
        return np.zeros(min(k, d)), np.eye(d)[:, :k]
    tiny = scale * np.finfo(float).eps
    values, vectors = [], np.zeros((d, 0))
    rng = np.random.default_rng(11)
    for j in range(1, min(k, d) + 1):
        low, high = -scale - tiny, scale + tiny  # above(low) >= j > above(high)
        n_low, n_high = d, 0

        def halve():
            nonlocal low, high, n_low, n_high
            mid = (low + high) / 2
            n = above(v, mid)
            if n >= j:
                low, n_low = mid, n
            else:
                high, n_high = mid, n

        while (n_low != j or n_high != j - 1) and high - low > 8 * d * tiny:
            halve()  # one eigenvalue is left inside, or a tie within rounding
        x = rng.standard_normal(d)
        while True:
            x -= vectors @ (vectors.T @ x)
            x = _solved(v, (low + high) / 2, x / np.linalg.norm(x), tiny)
            x -= vectors @ (vectors.T @ x)
            x /= np.linalg.norm(x)
            e = float(x @ v @ x)
            for _ in range(8):
                if not low - 8 * d * tiny <= e <= high + 8 * d * tiny:
                    break  # drawn to a neighbour: slice further
                if np.linalg.norm(v @ x - e * x) <= 2 * tiny:
                    break
                y = _solved(v, e, x, tiny)
                y -= vectors @ (vectors.T @ y)
                x = y / np.linalg.norm(y)
                e = float(x @ v @ x)
            off = np.linalg.norm(v @ x - e * x)
            slack = 2 * off + 8 * d * tiny
            if off <= 64 * d * tiny and above(v, e - slack) >= j > above(v, e + slack):
                break
            if high - low <= 8 * d * tiny:
                raise ArithmeticError(f"eigenvalue {j} could not be certified")
            halve()
            x = rng.standard_normal(d)
        values.append(e)
        vectors = np.column_stack([vectors, x])
    return np.array(values), vectors


# --- Spark jobs -----------------------------------------------------------


def _integers(batches):
    for b in batches:
        usable, lengths, values = scaled(b.column("embedding"))
        yield pa.RecordBatch.from_arrays(
            [b.column("vec_id").filter(pa.array(usable)), pa.array(lengths.astype(np.int32)),
             list_array(lengths, values)], names=["vec_id", "dim", "x"])


def _cells(sums: np.ndarray):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums.astype(np.int64))], names=["cell", "v"])


def _added(fit: DataFrame, row_cells, peak) -> list[int]:
    """Exact sums over all rows of the integer cells that ``row_cells`` makes
    of a matrix; ``peak(matrix)`` bounds the size of one row's cells."""
    def run(batches):
        total, room = None, ROOM
        for b in batches:
            whole = matrix(b.column("x"), dim)
            step = max(1, int(ROOM / peak(whole)))
            for x in (whole[at : at + step] for at in range(0, len(whole), step)):
                need = peak(x) * len(x)
                if total is not None and need > room:
                    yield _cells(total)
                    total, room = None, ROOM
                cells = row_cells(x)
                total = cells if total is None else total + cells
                room -= need
        if total is not None:
            yield _cells(total)

    dim = fit.dim

    rows = fit.frame.mapInArrow(run, "cell int, v long").groupBy("cell").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    return [int(r.v) for r in sorted(rows)]


class _Fit:
    """The distinct vectors and their dimension."""

    def __init__(self, frame: DataFrame, dim: int):
        self.frame, self.dim = frame, dim


def covariance(fit: _Fit) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, V) of the fit list; n and sums are exact integers, V is the
    exact covariance rounded to double."""
    d = fit.dim
    first = _added(fit, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]),
                   lambda x: float(np.abs(x).max(initial=1)))
    if not first:
        return 0, [], np.zeros((0, 0))
    n, sums = first[0], first[1:]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    upper = np.triu_indices(d)

    def products(x):
        y = x - centre
        return np.concatenate([y.sum(axis=0), exact_products(y.T, y)[upper]])

    moments = _added(fit, products, lambda x: float(np.abs(x - centre).max(initial=1)) ** 2)
    s, m = moments[:d], moments[d:]
    v = np.zeros((d, d))
    for i, j, p in zip(*upper, m):
        v[i, j] = v[j, i] = (n * p - s[i] * s[j]) / (n * n)  # integers: one rounding
    return n, sums, v


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[pa.Array, pa.Array]:
    """Exact sums of (n*x - S)^2 as long (NULL beyond it) and as decimal."""
    top = max(abs(s) for s in sums) + n * int(np.abs(x).max(initial=0))
    if len(sums) * top * top < 2**63:
        out = ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1)
        return pa.array(out), pa.array(out).cast(pa.decimal128(38, 0))
    big = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return (pa.array([b if b < 2**63 else None for b in big], pa.int64()),
            pa.array(big, pa.decimal128(38, 0)))


def whiten(df: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of the rows of ``df`` (vec_id, embedding): one row
    per usable row and component, see the contract in ``SCHEMA``."""
    spark = df.sparkSession
    rows = written(df.select("vec_id", "embedding").mapInArrow(_integers, "vec_id long, dim int, x array<int>"),
                   "whiten-rows")
    dims = rows.agg(F.min("dim").alias("least"), F.max("dim").alias("most")).first()
    d = dims.most or 0
    x = F.col("x") if dims.least == d else F.concat("x", F.array_repeat(F.lit(0), F.lit(d) - F.col("dim")))
    empty = spark.createDataFrame([], SCHEMA)
    if not d:
        return empty
    fit = _Fit(written(rows.select(x.alias("x")).distinct(), "whiten-fit"), d)
    n, sums, v = covariance(fit)
    trace = float(np.trace(v))
    e, u = leading(v, k)
    real = e > FLAT * trace
    if not real.any():
        return empty
    e, u = e[real], u[:, real]
    k = len(e)
    mean = [divmod(s, n) for s in sums]
    whole, part = np.array([q for q, _ in mean], dtype=np.int64), np.array([r / n for _, r in mean])
    axes = u / np.sqrt(e)

    def projected(x: np.ndarray) -> np.ndarray:
        return ((x - whole) - part) @ axes

    def measured(batches):
        for b in batches:
            w = projected(matrix(b.column("x"), d))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.sum(axis=0).tolist()]), pa.array([(w.T @ w).ravel().tolist()])], names=["s", "p"])

    # One row per task batch; the few cells of each are summed by position.
    sent = fit.frame.mapInArrow(measured, "s array<double>, p array<double>")
    total = sent.select(
        *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col("p")[i]).alias(f"p{i}") for i in range(k * k)]).first()
    s = np.array([total[f"s{i}"] for i in range(k)]) / n
    p = np.array([total[f"p{i}"] for i in range(k * k)]).reshape(k, k) / n
    error = float(np.abs(p - np.outer(s, s) - np.eye(k)).max())
    explained = e / trace

    def out(batches):
        for b in batches:
            x = matrix(b.column("x"), d)
            m = len(x)
            long, exact = _deviations(x, n, sums)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)), long.take(each), pa.array(projected(x).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)), exact.take(each),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                      "deviation_exact"])

    return rows.select("vec_id", "x").mapInArrow(out, SCHEMA)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitening of the whole ``embeddings`` table."""
    return whiten(table(spark, sf_dir, "embeddings"))
