"""Counts, means and co-moments of every pair of numeric columns as one mergeable state.

A task reads its rows in Arrow batches, reduces each batch to matrices
(columns x columns, by matrix products of the batch centred on its means) and
merges them by Chan's rule: two states of n1 and n2 rows whose means differ by
d add d d' n1 n2 / (n1 + n2) to the sum of their co-moments. Rows are neither
unfolded into pairs nor shuffled. A task sends one row for each pair, and
those are merged by the same rule, pair by pair.

Correlations (``pair_rows``) and least squares with a rank check
(``linear_fit``) follow from the state. NULLs are deleted pairwise; a pair
with a NaN or an infinity in a row that counts is told by ``odd``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of a column's spread that earlier columns must leave unexplained for it to count as independent.
RANK_TOLERANCE = 1e-9
_STATE = "a int, b int, n double, odd double, mean_a double, mean_b double, m_aa double, m_bb double, m_ab double"
_NAMES = [field.split()[0] for field in _STATE.split(", ")]


class _State(NamedTuple):
    """One entry a pair in each array."""

    n: np.ndarray
    odd: np.ndarray
    mean_a: np.ndarray
    mean_b: np.ndarray
    m_aa: np.ndarray
    m_bb: np.ndarray
    m_ab: np.ndarray

    def merged(self, other: _State) -> _State:
        n = self.n + other.n
        share = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        da, db, weight = other.mean_a - self.mean_a, other.mean_b - self.mean_b, self.n * share
        return _State(n, self.odd + other.odd, self.mean_a + da * share, self.mean_b + db * share,
                      self.m_aa + other.m_aa + da * da * weight, self.m_bb + other.m_bb + db * db * weight,
                      self.m_ab + other.m_ab + da * db * weight)


def comoments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A row for each pair a <= b of places in ``cols``: n, odd, mean_a, mean_b,
    m_aa, m_bb, m_ab (sums of products of the distances from the means). No row for a table without rows."""
    upper = np.triu_indices(len(cols))
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = _of_batch(batch, upper)
                total = own if total is None else total.merged(own)
        if total is not None:
            yield pa.record_batch([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)),
                                   *map(pa.array, total)], _NAMES)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], _State] = {}
        for batch in batches:
            values = np.stack([c.to_numpy() for c in batch.columns[2:]])
            for key, entry in zip(zip(*(c.to_pylist() for c in batch.columns[:2])), values.T, strict=True):
                own = _State(*entry)
                held[key] = held[key].merged(own) if key in held else own
        if held:
            keys, states = np.array(list(held), dtype=np.int32), np.array(list(held.values()), dtype=float)
            yield pa.record_batch([pa.array(keys[:, 0]), pa.array(keys[:, 1]), *map(pa.array, states.T)], _NAMES)

    return data.mapInArrow(reduced, _STATE).repartition("a", "b").mapInArrow(merged, _STATE)


def _of_batch(batch: pa.RecordBatch, upper: tuple[np.ndarray, np.ndarray]) -> _State:
    given = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
    x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
    used = given & np.isfinite(x)
    mask = used.astype(float)
    x = np.where(used, x, 0.0)
    center = x.sum(axis=0) / np.maximum(1.0, mask.sum(axis=0))
    y = np.where(used, x - center, 0.0)
    n = mask.T @ mask
    mean = np.divide(y.T @ mask, n, out=np.zeros_like(n), where=n > 0)  # of the row's column where the other has a value
    spread = np.maximum(0.0, (y * y).T @ mask - n * mean * mean)
    both = y.T @ y - n * mean * mean.T
    odd = given.astype(float).T @ given.astype(float) - n
    mean = mean + center[:, None]
    return _State(n[upper], odd[upper], mean[upper], mean.T[upper], spread[upper], spread.T[upper], both[upper])


def pair_rows(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(feature_a, feature_b, r) of each pair. r is NULL for fewer than two rows or
    a column without spread, NaN where a NaN or an infinity is among the values."""
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    place = {c: i for i, c in enumerate(cols)}
    wanted = df.sparkSession.createDataFrame([(x, y, *sorted((place[x], place[y]))) for x, y in pairs],
                                             "feature_a string, feature_b string, a int, b int")

    def flat(m: str, mean: str):  # what rounding of the mean alone may leave
        return F.col(m) <= F.col("n") * F.pow(F.lit(1e-14) * F.col(mean), F.lit(2.0))
    none = F.col("n").isNull() | (F.col("n") < 2) | flat("m_aa", "mean_a") | flat("m_bb", "mean_b")
    r = (F.when(F.col("odd") > 0, F.lit(float("nan"))).when(none, F.lit(None).cast("double"))
         .otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("m_ab") / (F.sqrt("m_aa") * F.sqrt("m_bb"))))))
    return (wanted.join(F.broadcast(comoments(df, cols)), ["a", "b"], "left")  # a row for each pair of columns at most
            .select("feature_a", "feature_b", r.alias("r")))


def linear_fit(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Least squares with an intercept on the rows without NULLs, from one pass: term, coefficient, n, rank.

    The normal equations of the centred columns are taken in order; a feature
    that those before it explain (or that is constant) adds no rank and has a NULL
    coefficient, so collinear features give a fit and not an error. No rows: all NULL."""
    cols = [*features, label]
    spread = np.zeros((len(cols), len(cols)))
    means = np.zeros(len(cols))
    n = 0
    for r in comoments(df.dropna(subset=cols), cols).collect():  # a row for each pair of columns
        spread[r["a"], r["b"]] = spread[r["b"], r["a"]] = r["m_ab"]
        if r["a"] == r["b"]:
            means[r["a"]], n = r["mean_a"], int(r["n"])
    kept: list[int] = []
    scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
    unit = spread / np.where(np.outer(scale, scale) > 0, np.outer(scale, scale), 1.0)
    for j in range(len(features)):
        if scale[j] > 1e-14 * np.sqrt(n) * abs(means[j]):
            explained = unit[j, kept] @ np.linalg.solve(unit[np.ix_(kept, kept)], unit[kept, j]) if kept else 0.0
            if 1 - explained > RANK_TOLERANCE:
                kept.append(j)
    weights = np.linalg.solve(unit[np.ix_(kept, kept)], unit[kept, -1]) * scale[-1] / scale[kept] if kept else np.zeros(0)
    found = dict(zip(kept, weights.tolist(), strict=True))
    intercept = means[-1] - sum(w * means[j] for j, w in found.items()) if n else None
    rows = [("intercept", None if intercept is None else float(intercept), n, len(kept))]
    rows += [(c, found.get(j), n, len(kept)) for j, c in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double, n long, rank int")
