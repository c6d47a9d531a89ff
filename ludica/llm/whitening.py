"""Embedding whitening (operator 11): mixed-precision refined eigenvectors of a distributed covariance.

Entries become fixed-point whole numbers, x = floor(scale * c) + OFFSET, so
that sums and deviations are exact. One pass counts and sums them, a second one
adds up the covariance of the centred rows (float64, divisor n): every task
reduces its rows to one d x d matrix, whose rows are summed by their index.
Only d numbers a component and the d x d matrix reach the driver, whatever the
number of vectors.

Eigenvectors come from a float32 decomposition, which holds about seven
digits, and are corrected by Ogita and Aishima's iteration in float64: two
residual products R = I - X'X and S = X'AX give a correction of all vectors by
matrix products alone, with quadratic convergence. Vectors whose eigenvalues
lie closer than what the residuals can tell apart are left to the second part
of the method: the cluster's own small matrix, shifted by the cluster's mean, is
decomposed in float64 and its vectors turned by the result.

Defined cases:

* a null vector and one with a null, NaN or infinite entry are left out,
* of vectors of several lengths the most common length counts (of equally
  common ones the shorter); the others are left out. No vector, or only empty
  ones: no row,
* repeated and null ids: every row stands for itself,
* components whose eigenvalue is not above RANK_CUT of the largest have no
  direction of their own and are left out, so constant vectors give no row,
* an entry beyond 2**62 / scale counts as that bound; a deviation that does not
  fit in a long is null,
* other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Added to every fixed-point entry.
OFFSET = 1_000_000
#: Components of which the query tells.
COMPONENTS = 32
#: Eigenvalues up to this part of the largest count as zero.
RANK_CUT = 1e-11
#: Corrections at most; two or three suffice where no eigenvalues cluster.
STEPS = 12
_LIMIT = 2.0 ** 62


class Whitening(NamedTuple):
    """A fitted map. vectors: a column a component, by falling eigenvalue."""

    n: int
    scale: float
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def clean_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<double>): the vectors without null or non-finite entries, of the most common length."""
    finite = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(
        F.col("v").isNotNull()
        & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))))
    lengths = finite.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    return finite.filter(F.size("v") == (lengths[0]["length"] if lengths else 0))


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: float = 64.0) -> Whitening | None:
    """The whitening of ``clean_vectors``; None where there is nothing to whiten."""
    n, sums = _sums(vectors, scale)
    if not n or not sums:
        return None
    covariance = _co_moments(vectors, len(sums), lambda batch: _centred(_fixed_point(batch, scale), n, sums)) / n
    values, x = refined_eigh(covariance)
    kept = min(components, int((values > RANK_CUT * values[0]).sum())) if values[0] > 0 else 0
    if not kept:
        return None
    return Whitening(n, scale, sums, x[:, :kept], values[:kept], float(np.trace(covariance)))


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation long, whitened array<double>): the exact sum of squares of n * x - S,
    and the centred row on each component over the root of its eigenvalue."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _fixed_point(batch, model.scale)
            white = _whitened(x, model)
            offsets = np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)
            yield pa.record_batch([batch.column("id"), _deviations(x, model.n, model.sums),
                                   pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))],
                                  ["id", "deviation", "whitened"])
    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance (divisor n, centred) minus the identity."""
    k = len(model.values)
    mean = np.array(_gathered(vectors, lambda batch: _whitened(_fixed_point(batch, model.scale), model).sum(axis=0)[None], k,
                              "double")[0]) / model.n
    moments = _co_moments(vectors, k, lambda batch: _whitened(_fixed_point(batch, model.scale), model) - mean)
    return float(np.abs(moments / model.n - np.eye(k)).max())


def component_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    vectors = clean_vectors(df, id_col, vector_col)
    model = fit(vectors, components)
    if model is None:
        none = F.lit(None)
        return vectors.limit(0).select(
            F.col("id").alias(id_col), none.cast("int").alias("component"), none.cast("long").alias("n"),
            none.cast("long").alias("deviation"), none.cast("double").alias("whitened"),
            none.cast("double").alias("explained"), none.cast("double").alias("identity_error"))
    error = identity_error(vectors, model)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return (whiten(vectors, model)
            .select("id", "deviation", F.posexplode("whitened").alias("at", "white"))
            .select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", F.col("white").alias("whitened"), F.get(shares, F.col("at")).alias("explained"),
                    F.lit(error).alias("identity_error")))


# --- eigenvectors -------------------------------------------------------------------------

def refined_eigh(a: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns; the largest entry is
    positive) of a symmetric float64 matrix, from a float32 decomposition."""
    a = (a + a.T) / 2
    largest = np.abs(a).max()
    if not largest:
        return np.zeros(len(a)), np.eye(len(a))
    unit = 2.0 ** np.floor(np.log2(largest))  # a power of two: scaling rounds nothing
    a = a / unit
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    for _ in range(steps):
        x, change = _corrected(a, x)
        if change <= 4 * np.finfo(float).eps * np.sqrt(len(a)):
            break
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.linalg.norm(x[:, order], axis=0)
    x *= np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1.0, 1.0)
    return values[order] * unit, x


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, float]:
    """One step of the iteration, clusters solved; and the size of its correction."""
    r = np.eye(len(a)) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2  # rounding that is not symmetric would grow by 1 / gap and cost orthogonality
    values = np.diag(s) / (1 - np.diag(r))
    delta = 2 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
    gaps = values[None, :] - values[:, None]
    close = np.abs(gaps) <= delta
    correction = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1.0, gaps))
    x = x + x @ correction
    order = np.argsort(values, kind="stable")
    for cluster in np.split(order, np.flatnonzero(np.diff(values[order]) > delta) + 1):
        if len(cluster) > 1:
            x[:, cluster] = _turned(a, x[:, cluster])
    return x, float(np.abs(correction).max())


def _turned(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The vectors of a cluster, turned to the eigenvectors of their own shifted matrix."""
    av = a @ v
    shift = np.einsum("ij,ij->", v, av) / np.einsum("ij,ij->", v, v)
    own = v.T @ (av - shift * v)
    return v @ np.linalg.eigh((own + own.T) / 2)[1]


def _norm(m: np.ndarray) -> float:
    """A bound on the spectral norm of a symmetric matrix."""
    return min(float(np.linalg.norm(m)), float(np.abs(m).sum(axis=0).max()))


# --- sums over all rows -------------------------------------------------------------------

def _fixed_point(batch: pa.RecordBatch, scale: float) -> np.ndarray:
    """x of every row of the batch (rows x d, int64)."""
    lists = batch.column("v")
    entries = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    return np.clip(np.floor(scale * entries), -_LIMIT, _LIMIT).astype(np.int64) + OFFSET


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, rounded once."""
    exact, whole = _differences(x, n, sums)
    out = whole.astype(np.float64) / n
    for i, row in exact.items():
        out[i] = [v / n for v in row]
    return out


def _differences(x: np.ndarray, n: int, sums: list[int]) -> tuple[dict[int, list[int]], np.ndarray]:
    """n * x - S as int64, and as whole numbers of Python the rows that do not
    fit. Products that wrap around are right again after the subtraction if the
    difference fits."""
    mean = np.array([s / n for s in sums])
    wide = np.flatnonzero((np.abs(x - mean).max(axis=1, initial=0) * n) >= _LIMIT)
    with np.errstate(over="ignore"):
        whole = x * np.int64(n) - np.array([_wrapped(s) for s in sums], dtype=np.int64)
    return {int(i): [n * int(v) - s for v, s in zip(x[i], sums, strict=True)] for i in wide}, whole


def _wrapped(value: int) -> int:
    return (value + 2 ** 63) % 2 ** 64 - 2 ** 63


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    exact, whole = _differences(x, n, sums)
    estimate = (whole.astype(np.float64) ** 2).sum(axis=1)
    with np.errstate(over="ignore"):
        squares = (whole * whole).sum(axis=1)
    out = squares.tolist()
    for i in {*exact, *np.flatnonzero(estimate >= _LIMIT).tolist()}:
        total = sum(v * v for v in exact.get(i, whole[i].tolist()))
        out[i] = total if total < 2 ** 63 else None
    return pa.array(out, pa.int64())


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ model.vectors / np.sqrt(model.values)


def _sums(vectors: DataFrame, scale: float) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each entry of x. Halves of 32
    bits are summed apart, so no sum of a task overflows; their totals are decimals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and len(batch.column("v").flatten()):
                x = _fixed_point(batch, scale)
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                yield pa.record_batch([pa.array(np.arange(len(high), dtype=np.int32)), pa.array(np.full(len(high), len(x))),
                                       pa.array(high), pa.array(low)], ["i", "n", "high", "low"])
    rows = (vectors.mapInArrow(run, "i int, n long, high long, low long").groupBy("i")
            .agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")])
            .orderBy("i").collect())
    return (rows[0]["n"] if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _co_moments(vectors: DataFrame, width: int, centred: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of c c' over the centred rows c."""
    def products(batch: pa.RecordBatch) -> np.ndarray:
        c = centred(batch)
        return c.T @ c
    return np.array(_gathered(vectors, products, width, "double"))


def _gathered(vectors: DataFrame, matrix: Callable[[pa.RecordBatch], np.ndarray], width: int, kind: str) -> list[list]:
    """The sum of ``matrix`` over all batches: a task adds up its own, and the
    rows of the tasks' matrices are added up by their index."""
    schema = f"i int, entries array<{kind}>"

    def as_batch(keys: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        offsets = pa.array(np.arange(0, rows.size + 1, width, dtype=np.int32))
        return pa.record_batch([pa.array(keys, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))],
                               ["i", "entries"])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (matrix(batch) for batch in batches if batch.num_rows)
        total = _added(parts)
        if total is not None:
            yield as_batch(np.arange(len(total)), total)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch.column("entries").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            for key, row in zip(batch.column("i").to_pylist(), rows, strict=True):
                held[key] = held[key] + row if key in held else row.copy()
        if held:
            yield as_batch(np.fromiter(held, np.int32, len(held)), np.stack(list(held.values())))

    summed = vectors.mapInArrow(reduced, schema).repartition("i").mapInArrow(merged, schema)
    return [row["entries"] for row in sorted(summed.collect(), key=lambda row: row["i"])]


def _added(parts: Iterator[np.ndarray]) -> np.ndarray | None:
    total = None
    for part in parts:
        total = part if total is None else total + part
    return total
