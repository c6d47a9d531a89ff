"""Row-level cleaning: dedupe, predicates, outlier fences, seeded sampling.

R1-R12, Z1-Z2 and P1-P3 of the blueprint. Fences compute their bounds first
(a couple of doubles reach the driver) and then filter with literals, so the
filter is an ordinary predicate Catalyst can push into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludica.operators.ranking import quantiles


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Full-row (or subset) dedupe.

    Planned as a partial HashAggregate before the shuffle, so repeated
    copies of a row collapse map-side and a hot duplicate costs one row per
    map task.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def positive_filter(df: DataFrame, *cols: str) -> DataFrame:
    """Every named column > 0 (NULL fails)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) > 0)
    return df.where(cond)


def not_null_positive(df: DataFrame, col: str, cast: str | None = None) -> DataFrame:
    """Optional cast, then ``IS NOT NULL AND > 0``."""
    if cast:
        df = df.withColumn(col, F.col(col).cast(cast))
    return df.where(F.col(col).isNotNull() & (F.col(col) > 0))


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Listwise deletion over ``subset``."""
    return df.dropna(subset=list(subset))


def exclude_value(df: DataFrame, col: str, value) -> DataFrame:
    """Drop one category (NULL categories are kept, like pandas ``!=``)."""
    return df.where(F.col(col).isNull() | (F.col(col) != F.lit(value)))


@dataclass(frozen=True)
class Fence:
    lower: float | None
    upper: float | None
    q_low: float | None = None
    q_high: float | None = None

    def column(self, col: str) -> Column:
        """Inclusive ``between`` predicate."""
        if self.lower is None or self.upper is None:
            return F.lit(False)
        return F.col(col).between(F.lit(self.lower), F.lit(self.upper))


def _two_quantiles(df: DataFrame, col: str, lo: float, hi: float, method: str,
                   interpolation: str, relative_error: float) -> tuple[float | None, float | None]:
    if method == "approx":
        qs = df.approxQuantile(col, [lo, hi], relative_error)
        return (qs[0], qs[1]) if len(qs) == 2 else (None, None)
    row = quantiles(df, col, [lo, hi], ["_a", "_b"], method=method,
                    interpolation=interpolation).first()
    return (row["_a"], row["_b"]) if row is not None else (None, None)


def iqr_bounds(df: DataFrame, col: str, k: float = 1.5, method: str = "approx",
               relative_error: float = 0.01) -> Fence:
    """Z1 bounds: Q1 - k IQR, Q3 + k IQR.

    ``approx`` is ``approxQuantile`` with the given relative error (what the
    analysis does); ``exact`` returns the same data points an error of 0 would
    (1-based rank ceil(p n)) through the skew-safe rank selection.
    """
    q1, q3 = _two_quantiles(df, col, 0.25, 0.75, method, "disc", relative_error)
    if q1 is None or q3 is None:
        return Fence(None, None, q1, q3)
    iqr = q3 - q1
    return Fence(q1 - k * iqr, q3 + k * iqr, q1, q3)


def iqr_fence(df: DataFrame, col: str, k: float = 1.5, method: str = "approx",
              relative_error: float = 0.01) -> tuple[DataFrame, Fence]:
    """Rows inside the IQR fence, and the fence itself."""
    fence = iqr_bounds(df, col, k, method, relative_error)
    return df.where(fence.column(col)), fence


def percentile_bounds(df: DataFrame, col: str, lo: float = 5, hi: float = 95,
                      method: str = "exact") -> Fence:
    """Z2 bounds: numpy-style linear percentiles over all rows together."""
    a, b = _two_quantiles(df, col, lo / 100.0, hi / 100.0, method, "linear", 0.001)
    return Fence(a, b, a, b)


def percentile_trim(df: DataFrame, col: str, lo: float = 5, hi: float = 95,
                    method: str = "exact") -> tuple[DataFrame, Fence]:
    """Keep rows with lo-th <= value <= hi-th percentile (inclusive)."""
    fence = percentile_bounds(df, col, lo, hi, method)
    return df.where(fence.column(col)), fence


# --------------------------------------------------------------- sampling

def seeded_hash(key: str | Column, seed: int | str) -> Column:
    """md5 of ``'<seed>|<key>'`` as lowercase hex: a per-row draw that does
    not depend on partitioning and that any SQL engine can reproduce. A NULL
    key draws as the empty text, so its rows are drawn like any other key's."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(k.cast("string"), F.lit(""))))


def _threshold(fraction: float) -> str:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    return format(min(int(fraction * 2 ** 32), 2 ** 32 - 1), "08x")


def in_fraction(key: str | Column, fraction: float, seed: int | str) -> Column:
    """True for about ``fraction`` of the keys: first 8 hex digits < threshold."""
    if fraction >= 1.0:
        return F.lit(True)
    return F.substring(seeded_hash(key, seed), 1, 8) < F.lit(_threshold(fraction))


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42, key: str = "appID",
                    mode: str = "hash") -> DataFrame:
    """Sample without replacement.

    ``hash`` keeps rows whose seeded key hash falls under the threshold:
    repeatable across runs, plans and engines. ``bernoulli`` is Spark's
    ``df.sample`` (cheaper, but depends on the partitioning).
    """
    if mode == "bernoulli":
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(in_fraction(key, fraction, seed))


def split(df: DataFrame, fraction: float = 0.8, seed: int = 1234, key: str = "appID",
          mode: str = "hash") -> tuple[DataFrame, DataFrame]:
    """(first, rest) with ``fraction`` of the rows in the first part; every
    row is in exactly one of them, whatever its key."""
    if mode == "random":
        a, b = df.randomSplit([fraction, 1 - fraction], seed=seed)
        return a, b
    cond = in_fraction(key, fraction, seed)
    return df.where(cond), df.where(~cond)


#: Downsampling refines the boundary bucket until at most this many rows are ranked.
EDGE_ROWS = 100_000
_EDGE = "_edge_hash"


def downsample(df: DataFrame, n: int, seed: int = 42, key: str = "appID", edge_rows: int = EDGE_ROWS) -> DataFrame:
    """Exactly ``n`` rows without replacement - the ``n`` smallest seeded
    hashes (ties by a hash of the whole row).

    Never ranks the whole input in one task: the hash of the key, continued by
    a hash of the row, is uniform also where many rows share a key, and its
    hex prefixes split the rows into 4096 near-equal buckets. Bucket counts
    (<= 4096 numbers) locate the bucket holding rank ``n``; everything below
    it is kept by a plain filter, and only that bucket is refined further,
    until it holds at most ``edge_rows`` rows. Those are ranked by a window;
    rows that agree in the whole hash are copies of each other, and are taken
    by their count. Raises if fewer than ``n`` rows exist, as a draw without
    replacement must.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    digest = F.concat(seeded_hash(key, seed), F.lower(F.lpad(F.hex(F.xxhash64(*columns)), 16, "0")))
    hashed = df.withColumn(_EDGE, digest)
    length = 48

    def prefix_counts(base: DataFrame, plen: int) -> list[tuple[str, int]]:
        return sorted((r[0], r[1]) for r in
                      base.groupBy(F.substring(_EDGE, 1, plen).alias("_p")).count().collect())

    counts = prefix_counts(hashed, 3)          # also gives the total: no separate count
    total = sum(c for _, c in counts)
    if n > total:
        raise ValueError(f"cannot take {n} rows without replacement from {total}")
    if n == total:
        return df
    if n <= 0:
        return df.limit(0)
    prefix, remaining, edge = "", n, total
    kept_below = hashed.where(F.lit(False))
    while edge > edge_rows and len(prefix) < length:
        if prefix:
            counts = prefix_counts(hashed.where(F.col(_EDGE).startswith(prefix)), len(prefix) + 3)
        below = 0
        for boundary, edge in counts:
            if below + edge >= remaining:
                break
            below += edge
        # hashes under the boundary: no string under it starts with it
        kept_below = hashed.where(F.col(_EDGE) < F.lit(boundary))
        remaining -= below
        prefix = boundary
    base = hashed.where(F.col(_EDGE).startswith(prefix))
    if edge <= edge_rows:
        w = Window.orderBy(_EDGE)
        last = base.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= remaining).drop("_r")
    else:
        copies = base.groupBy(*base.columns).agg(F.count(F.lit(1)).alias("_n"))
        last = (copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(F.col("_n"), F.lit(remaining)).cast("int"))))
                .drop("_n", "_copy"))
    return kept_below.unionByName(last).drop(_EDGE)
