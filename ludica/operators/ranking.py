"""Exact ranks and quantiles that stay distributed under skew.

The naive forms - an unpartitioned window for global ranks, or a per-group
sort for exact percentiles - put a whole group (possibly a third of all
rows) into one task. Here the work is split in two steps:

1. ``value_counts``: one row per distinct (group, value) with its count.
   Partial aggregation collapses duplicates map-side, so a hot value costs
   one row per map task. The table is materialized and counted.
2. ``running_counts``: the distinct values are cut into value-range buckets
   whose bounds come from an approximate quantile sketch (a bounded number of
   doubles reaches the driver). A window per (group, bucket) gives running
   counts inside a bucket; per-bucket totals (groups x buckets rows) give the
   offsets. A hot group is therefore spread over all buckets.

Quantiles need no ranks of all rows: ``quantiles`` narrows down on the few
that it asks for (``narrowing``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludica.operators.narrowing import narrowed_quantiles

COUNT = "_n"
CUM = "_cum"          # running count including the row's value
BUCKET = "_bucket"


def _as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


ROWS_PER_BUCKET = 500_000
MAX_BUCKETS = 65_536


def default_buckets(df: DataFrame, n_rows: int | None = None) -> int:
    """Buckets for a prefix sum over ``n_rows`` distinct rows: about
    ``ROWS_PER_BUCKET`` rows each (so one window partition stays small),
    at least 8, at most ``MAX_BUCKETS`` sketch points to the driver. Without a
    row count, a few per shuffle partition of the session."""
    if n_rows is not None:
        return int(min(MAX_BUCKETS, max(8, math.ceil(n_rows / ROWS_PER_BUCKET))))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return int(min(MAX_BUCKETS, max(8, 4 * parts)))


def value_counts(df: DataFrame, value: str, group: str | Sequence[str] | None = None,
                 extra_sums: dict[str, object] | None = None) -> DataFrame:
    """Distinct (group, value) rows with their multiplicity in ``_n``.

    NULL values are dropped (they have no rank). ``extra_sums`` adds
    further summed columns, e.g. per-sample counts for rank tests.
    """
    g = _as_list(group)
    aggs = [F.count(F.lit(1)).alias(COUNT)]
    for name, expr in (extra_sums or {}).items():
        aggs.append(F.sum(expr).alias(name))
    return df.where(F.col(value).isNotNull()).groupBy(*g, value).agg(*aggs)


def bucket_bounds(vc: DataFrame, value: str, buckets: int) -> list[float]:
    """Strictly increasing inner split points over the distinct values."""
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    qs = vc.approxQuantile(value, probs, 1.0 / (2 * buckets))
    out: list[float] = []
    for q in qs:
        if q is None or (isinstance(q, float) and math.isnan(q)):
            continue
        if not out or q > out[-1]:
            out.append(float(q))
    return out


def running_counts(vc: DataFrame, value: str, group: str | Sequence[str] | None = None,
                   count: str = COUNT, buckets: int | None = None,
                   materialize: bool = True) -> DataFrame:
    """Add ``_cum`` (running count up to and including the value) and ``_total``.

    ``vc`` holds distinct (group, value) rows with a count column. Ordering is
    by value within each group. The result is exact whatever the bucket
    bounds are (they only balance the work), so recomputing ``vc`` after an
    executor loss cannot change it. ``materialize`` checkpoints ``vc`` to the
    shared checkpoint directory first, so the bounds sketch and the final
    pass read the small distinct-value table instead of rescanning the
    source twice - worth it when the source is expensive to recompute.
    """
    g = _as_list(group)
    if materialize:
        vc = vc.checkpoint(eager=True)
    nb = buckets if buckets is not None else default_buckets(vc, vc.count() if materialize else None)
    inner = bucket_bounds(vc, value, nb)
    vd = "_v_double"
    if inner:
        bucketed = Bucketizer(splits=[-math.inf] + inner + [math.inf], inputCol=vd,
                              outputCol=BUCKET, handleInvalid="keep").transform(
            vc.withColumn(vd, F.col(value).cast("double"))).drop(vd)
    else:                 # a single distinct value, or none
        bucketed = vc.withColumn(BUCKET, F.lit(0.0))

    totals = bucketed.groupBy(*g, BUCKET).agg(F.sum(count).alias("_bt"))
    wg = Window.partitionBy(*g).orderBy(BUCKET)
    offsets = totals.select(
        *g, BUCKET,
        F.coalesce(F.sum("_bt").over(wg.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_bt").over(Window.partitionBy(*g)).alias("_total"),
    )
    wb = Window.partitionBy(*g, BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    within = bucketed.withColumn("_cin", F.sum(count).over(wb))
    # null-safe: a NULL group is a group
    to = offsets.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)],
                        F.col(BUCKET).alias("_b"), "_off", "_total")
    same = F.col(BUCKET) == F.col("_b")
    for i, c in enumerate(g):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return (within.join(to, same, "inner")
            .withColumn(CUM, F.col("_off") + F.col("_cin"))
            .drop("_off", "_cin", "_b", *[f"_g{i}" for i in range(len(g))]))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
              group: str | Sequence[str] | None = None, method: str = "exact",
              interpolation: str = "linear", accuracy: int = 10000,
              buckets: int | None = None) -> DataFrame:
    """Per-group quantiles of ``value`` as columns ``names``.

    method ``exact``: rank narrowing (``narrowing.narrowed_quantiles``): sketch
      bounds, exact counts of the cells between them, values only near the
      wanted ranks (skew-safe; NULL is a group like any other). With a number
      of ``buckets``, running counts over the distinct values instead.
      ``linear`` interpolation equals numpy's default percentile / SQL
      ``percentile`` / DuckDB ``quantile_cont``; ``disc`` returns the value
      at 1-based rank ceil(p n), as ``percentile_disc`` and
      ``approxQuantile(..., 0.0)`` do.
    method ``builtin``: Spark's ``percentile`` / ``percentile_disc``
      aggregates (exact; their per-group state is a value->count map, so
      memory grows with the distinct values of a group).
    method ``approx``: ``percentile_approx`` - bounded-memory sketch.
    """
    g = _as_list(group)
    if len(probs) != len(names):
        raise ValueError("one name per probability")
    v = F.col(value)
    if method == "approx":
        arr = F.percentile_approx(v, list(probs), accuracy)
        res = df.groupBy(*g).agg(arr.alias("_q"))
        return res.select(*g, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)])
    if method == "builtin":
        if interpolation == "linear":
            aggs = [F.percentile(v, p).cast("double").alias(n) for p, n in zip(probs, names)]
        else:
            aggs = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{value}`)")
                    .cast("double").alias(n) for p, n in zip(probs, names)]
        return df.groupBy(*g).agg(*aggs)
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")

    if buckets is None:
        return narrowed_quantiles(df, value, probs, names, g, interpolation)
    return quantiles_of_counts(value_counts(df, value, g).checkpoint(eager=True), value, probs, names, g, interpolation, buckets)


def quantiles_of_counts(vc: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                        group: str | Sequence[str] | None = None, interpolation: str = "linear",
                        buckets: int | None = None) -> DataFrame:
    """Exact quantiles from a materialized table of distinct (group, value,
    count) rows, as ``value_counts`` makes it."""
    g = _as_list(group)
    nb = buckets if buckets is not None else default_buckets(vc, vc.count())
    rc = running_counts(vc, value, g, buckets=nb, materialize=False)
    total = F.col("_total").cast("double")
    aggs = []
    for i, p in enumerate(probs):
        if interpolation == "linear":
            pos = (total - 1) * F.lit(float(p))
            lo, hi = F.floor(pos), F.ceil(pos)
            rc = (rc.withColumn(f"_lo{i}", F.when(F.col(CUM) > lo, F.col(value)))
                    .withColumn(f"_hi{i}", F.when(F.col(CUM) > hi, F.col(value)))
                    .withColumn(f"_fr{i}", pos - lo))
        elif interpolation == "disc":
            rank = F.greatest(F.ceil(total * F.lit(float(p))), F.lit(1))  # 1-based
            rc = rc.withColumn(f"_lo{i}", F.when(F.col(CUM) >= rank, F.col(value)))
        else:
            raise ValueError(f"unknown interpolation {interpolation!r}")
        aggs.append(F.min(f"_lo{i}").cast("double").alias(f"_lo{i}"))
        if interpolation == "linear":
            aggs += [F.min(f"_hi{i}").cast("double").alias(f"_hi{i}"),
                     F.max(f"_fr{i}").alias(f"_fr{i}")]
    agg = rc.groupBy(*g).agg(*aggs)
    outs = []
    for i, n in enumerate(names):
        if interpolation == "linear":
            lo_v, hi_v, fr = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_fr{i}")
            outs.append(F.when(fr == 0, lo_v).otherwise(lo_v + fr * (hi_v - lo_v)).alias(n))
        else:
            outs.append(F.col(f"_lo{i}").alias(n))
    return agg.select(*g, *outs)
