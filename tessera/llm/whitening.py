"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers ``u = floor(64 c)``; the constant that a caller
adds to them cancels in everything centred, so it is left out. The vectors
are packed into blocks once (a written table). A pass multiplies the centred
vectors with a thin matrix on every block and sums the products, so that
``V Q`` of the covariance ``V`` is formed without ``V``. A Chebyshev
polynomial of ``V``, one pass a degree, damps the part of the spectrum below
the block's last Ritz value; QR and Rayleigh-Ritz follow. This repeats until
the residuals of all wanted pairs are at the level of rounding. The lower end
of the spectrum, which bounds the damped interval, comes from a few Lanczos
steps.

The driver holds matrices of ``dims`` times (components + guard) and at most
``REDUCERS`` partial sums of that size, whatever the number of rows; centring
and sums of whole numbers are exact.

Defined cases: vectors that are null or hold null or non-finite entries are
left out, and so are empty ones and those of another length than the most
frequent one (of equally frequent lengths the larger). An entry beyond 2**61
in size is an error. Repeated rows and ties count each; other columns, null
ids included, pass through; a column named as an output is replaced. Components whose
variance is below 1e-10 of the largest are numerically none and left out, so
equal vectors, a single one and an empty table have no component. Very
long vectors cost memory of a block and the thin matrices only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.components import tasks_for, written

SCALE = 64.0
BLOCK_ENTRIES = 1 << 18
BLOCKS_PER_TASK = 16
GUARD = 16
DEGREE = 10
LANCZOS = 12
REDUCERS = 16
NONE = 1e-10  # variances below this share of the largest
_SAFE = 1 << 62


def usable(column: Column) -> Column:
    """True for vectors without null or non-finite entries."""
    bad = F.exists(column, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return column.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _whole(column: pa.Array, dims: int) -> np.ndarray:
    """floor(64 c) of list values, one row for each vector."""
    u = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if u.size and np.abs(u).max() >= 2.0 ** 61:
        raise OverflowError("an entry is too large for a whole number of 61 bits")
    return u.astype(np.int64).reshape(-1, dims)


def _pack(dims: int):
    rows = max(1, BLOCK_ENTRIES // dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = _whole(batch.column(0), dims)
            for a in range(0, len(u), rows):
                part = u[a:a + rows]
                narrow = np.abs(part).max() < 1 << 31
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(part)], pa.int32()), pa.array([bool(narrow)]),
                     pa.array([part.astype("<i4" if narrow else "<i8").tobytes()], pa.binary()),
                     pa.array([[Decimal(int(v)) for v in _sum(part)]], pa.list_(pa.decimal128(38, 0)))],
                    names=["n", "narrow", "u", "total"])

    return run


def _sum(u: np.ndarray) -> np.ndarray:
    return (u if int(np.abs(u).max()) * len(u) < _SAFE else u.astype(object)).sum(axis=0)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for narrow, raw in zip(batch.column("narrow").to_pylist(), batch.column("u")):
            yield np.frombuffer(raw.as_buffer(), dtype="<i4" if narrow else "<i8").reshape(-1, dims).astype(np.int64)


def centred(u: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """Rows minus their mean: exact up to the last division."""
    most = max(int(np.abs(u).max()) if u.size else 0, 1)
    if n * most + max(map(abs, total), default=0) < _SAFE:
        return (n * u - np.array(total, dtype=np.int64)) / float(n)
    return ((u.astype(object) * n - np.array(total, dtype=object)) / n).astype(np.float64)


def deviations(u: np.ndarray, n: int, total: list[int]) -> list[int]:
    """Sum over entries of (n u - total) squared, exact, for each row."""
    most, far = max(int(np.abs(u).max()) if u.size else 0, 1), max(map(abs, total), default=0)
    if most * max(most, far) * max(u.shape[1], 1) < _SAFE:
        squares, across = (u * u).sum(axis=1), (u @ np.array(total, dtype=np.int64))
    else:
        v = u.astype(object)
        squares, across = (v * v).sum(axis=1), (v * np.array(total, dtype=object)).sum(axis=1)
    own = sum(t * t for t in total)
    return [n * n * int(a) - 2 * n * int(b) + own for a, b in zip(squares, across)]


def summed(blocks: DataFrame, tasks: int, dims: int, shape: tuple[int, ...], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``part(u)`` over all blocks, read by ``tasks`` tasks: one row a task, merged to ``REDUCERS`` rows where there are more."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = None
        for u in _blocks(batches, dims):
            acc = part(u) if acc is None else acc + part(u)
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array([acc.tobytes()], pa.binary())], names=["s"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = None
        for batch in batches:
            for raw in batch.column("s"):
                v = np.frombuffer(raw.as_buffer(), dtype=np.float64)
                acc = v if acc is None else acc + v
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array([acc.tobytes()], pa.binary())], names=["s"])

    rows = blocks.select("narrow", "u").mapInArrow(sums, "s binary")
    got = (rows if tasks <= REDUCERS else rows.repartition(REDUCERS).mapInArrow(merged, "s binary")).toArrow()
    out = np.zeros(int(np.prod(shape)))
    for raw in got.column("s").to_pylist():
        out += np.frombuffer(raw, dtype=np.float64)
    return out.reshape(shape)


def lowest(apply: Callable[[np.ndarray], np.ndarray], dims: int, rng: np.random.Generator) -> float:
    """A bound from below of the spectrum, from a few Lanczos steps (0 at least: a covariance has no smaller value)."""
    q = rng.standard_normal(dims)
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(min(LANCZOS, dims)):
        z = apply(basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ z))
        for _ in range(2):
            for b in basis:
                z = z - (b @ z) * b
        beta.append(float(np.linalg.norm(z)))
        if beta[-1] <= 1e-12 * max(abs(alpha[0]), 1e-300):
            break
        basis.append(z / beta[-1])
    k = len(alpha)
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:k - 1], 1) + np.diag(beta[:k - 1], -1))
    return max(0.0, float(values[0] - beta[-1] * abs(vectors[-1, 0])))


def chebyshev(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float,
              degree: int) -> np.ndarray:
    """The Chebyshev polynomial of ``V`` that stays small on [low, high], times ``q``; scaled to about 1 at ``top``."""
    centre, half = (low + high) / 2, max((high - low) / 2, 1e-6 * top)
    first = half / max(top - centre, half)
    scale, before = first, q
    now = (vq - centre * q) * (scale / half)
    for _ in range(1, degree):
        nxt = 1 / (2 / first - scale)
        before, now = now, (apply(now) - centre * now) * (2 * nxt / half) - (scale * nxt) * before
        scale = nxt
    return now


def leading(apply: Callable[[np.ndarray], np.ndarray], dims: int, components: int, guard: int = GUARD, degree: int = DEGREE,
            cycles: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues (falling) and their vectors, by filtered subspace iteration.

    Certified when every wanted residual ``|V q - e q|`` is at the level of
    rounding, or no longer falls and is below 1e-12 of the largest value.
    """
    rng = np.random.default_rng(20260401)
    want, block = min(components, dims), min(components + guard, dims)
    q = np.linalg.qr(rng.standard_normal((dims, block)))[0]
    low = lowest(apply, dims, rng) if block < dims else 0.0
    last = np.inf
    for _ in range(cycles):
        vq = apply(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(float(values[0]), 0.0)
        wanted = [i for i in range(want) if values[i] > NONE * top]
        left = max((float(np.linalg.norm(vq[:, i] - values[i] * q[:, i])) for i in wanted), default=0.0)
        if not wanted or left <= 16 * np.finfo(float).eps * top or left <= 1e-12 * top and left > last / 2:
            return values[wanted], q[:, wanted]
        last = left
        q = np.linalg.qr(chebyshev(apply, q, vq, low, max(float(values[-1]), low), top, degree))[0]
    raise RuntimeError(f"whitening was not certified: residual {left:.3g} of {top:.3g}")


def fit(df: DataFrame, column: str = "embedding", components: int = 32, guard: int = GUARD, degree: int = DEGREE) -> dict:
    """Fit on all usable vectors: means, eigenpairs of the covariance, its trace, and the whitened rows' error.

    Gives ``n``, ``dims``, ``total`` (exact sums of floor(64 c)), ``values``,
    ``vectors`` (one column a component), ``trace`` and ``identity_error``:
    the largest entry of the whitened vectors' covariance minus the identity,
    from a pass over all of them.
    """
    vector = F.col(f"`{column}`").cast("array<double>")
    rows = df.select(vector.alias("v")).where(usable(F.col("v")) & (F.size("v") > 0))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return {"n": 0, "dims": 0, "total": [], "values": np.zeros(0), "vectors": np.zeros((0, 0)), "trace": 0.0, "identity_error": 0.0}
    dims = lengths[0]["d"]
    blocks, size = written(rows.where(F.size("v") == dims).mapInArrow(
        _pack(dims), "n int, narrow boolean, u binary, total array<decimal(38,0)>"), rows=BLOCKS_PER_TASK)
    tasks = tasks_for(size, BLOCKS_PER_TASK)
    n = blocks.agg(F.sum("n")).first()[0]
    sums = blocks.select(F.posexplode("total").alias("i", "t")).groupBy("i").agg(F.sum("t").alias("t")).collect()
    total = [int(r["t"]) for r in sorted(sums, key=lambda r: r["i"])]

    def apply(q: np.ndarray) -> np.ndarray:
        def part(u: np.ndarray) -> np.ndarray:
            x = centred(u, n, total)
            return x.T @ (x @ q)
        return summed(blocks, tasks, dims, q.shape, part) / n

    values, vectors = leading(apply, dims, components, guard, degree)
    turn = vectors / np.sqrt(values)[None, :]

    def moments(u: np.ndarray) -> np.ndarray:
        x = centred(u, n, total)
        w = x @ turn
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel(), [float((x * x).sum())]])

    k = len(values)
    got = summed(blocks, tasks, dims, (k + k * k + 1,), moments) / n
    cov = got[k:-1].reshape(k, k) - np.outer(got[:k], got[:k])
    return {"n": n, "dims": dims, "total": total, "values": values, "vectors": vectors, "trace": float(got[-1]),
            "identity_error": float(np.abs(cov - np.eye(k)).max(initial=0.0))}


def whiten(df: DataFrame, model: dict, column: str = "embedding") -> DataFrame:
    """``df``'s usable rows with a struct column ``whitening``: ``deviation`` (decimal, the sum over entries of
    (n u - total) squared, exact) and ``whitened`` (one double a component)."""
    out = T.StructType([T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    n, dims, total = model["n"], model["dims"], model["total"]
    turn = model["vectors"] / np.sqrt(model["values"])[None, :] if dims else None

    @F.arrow_udf(out)
    def project(vectors: pa.Array) -> pa.Array:
        u = _whole(vectors, dims)
        w = centred(u, n, total) @ turn
        k = w.shape[1]
        return pa.StructArray.from_arrays(
            [pa.array([Decimal(v) for v in deviations(u, n, total)], pa.decimal128(38, 0)),
             pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * k, pa.int32()), pa.array(w.ravel()))],
            names=["deviation", "whitened"])

    vector = F.col(f"`{column}`").cast("array<double>")
    kept = df.where(usable(vector) & (F.size(vector) == dims) & F.lit(dims > 0))
    if not dims:
        return kept.withColumn("whitening", F.lit(None).cast(out))
    return kept.withColumn("whitening", project(vector))


def components_of(df: DataFrame, model: dict, column: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """One row for each usable vector and component: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``. A deviation that no long holds is an error."""
    share = [float(v) / model["trace"] for v in model["values"]]
    rows = (whiten(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{column}`").alias("v")), model, "v")
            .select("id", F.col("whitening.deviation").cast("long").alias("deviation"),
                    F.posexplode("whitening.whitened").alias("at", "whitened")))
    return rows.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model["n"]).cast("long").alias("n"),
                       "deviation", "whitened", F.get(F.lit(share).cast("array<double>") if share else F.array().cast("array<double>"), F.col("at")).alias("explained"),
                       F.lit(model["identity_error"]).alias("identity_error"))
