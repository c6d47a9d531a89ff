"""Numbers behind the analysis figures (V1-V3, V5): box plots, histograms,
kernel density curves and scatter axis bounds, computed on Spark.

Each is a grouped aggregate; per-group parameters (quartiles, bandwidth,
grid) live in a k-row table that is materialized, size-checked and
broadcast back onto the rows (``aggregate.attach_summary``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludica.operators.aggregate import MAX_BROADCAST_GROUPS, attach_summary, materialize_summary
from ludica.operators.ranking import quantiles

_D = "double"


def box_stats(df: DataFrame, value: str, group: str, whis: float = 1.5,
              method: str = "exact") -> DataFrame:
    """V1: n, mean, quartiles (linear), whiskers and outlier count per group.

    Whiskers are the most extreme data points within ``whis`` IQR of the box,
    the matplotlib/seaborn rule; points beyond them are outliers.
    """
    # own names: the table may have columns called like the statistics
    base = (df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
            .select(F.col(group).alias("_group"), F.col(value).alias("_value")))
    q = quantiles(base, "_value", [0.25, 0.5, 0.75], ["q1", "median", "q3"], group="_group", method=method)
    q = q.withColumn("_lo", F.col("q1") - whis * (F.col("q3") - F.col("q1"))) \
         .withColumn("_hi", F.col("q3") + whis * (F.col("q3") - F.col("q1")))
    v = F.col("_value").cast(_D)
    inside = ~F.isnan(v) & (v >= F.col("_lo")) & (v <= F.col("_hi"))
    return attach_summary(base, q, "_group").groupBy(F.col("_group").alias(group)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"),
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("long").alias("n_outliers"),
    )


def _finite(v: Column) -> Column:
    return ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))


def histogram_edges(df: DataFrame, value: str, bins: int) -> tuple[float, float]:
    """Common range of the finite values of all groups (numpy: a constant column spans +-0.5)."""
    v = F.col(value).cast(_D)
    row = df.where(_finite(v)).agg(F.min(v).alias("a"), F.max(v).alias("b")).first()
    lo, hi = row["a"], row["b"]
    if lo is None:
        return 0.0, 1.0
    if lo == hi:
        return lo - 0.5, hi + 0.5
    return lo, hi


def histogram(df: DataFrame, value: str, group: str | None, bins: int) -> DataFrame:
    """V2: counts over ``bins`` equal-width bins with edges shared by all
    groups; the last bin is closed on the right. Every bin of every group has
    a row, empty ones with count 0. NaN and infinite values are in no bin: a
    group that has some counts them in one more row, whose bin and edges are NULL."""
    lo, hi = histogram_edges(df, value, bins)
    step = (hi - lo) / bins
    v = F.col("_value")
    keys = ["_group"] if group else []
    rows = df.select(*[F.col(group).alias(k) for k in keys], F.col(value).cast(_D).alias("_value"))
    idx = F.least(F.floor((v - F.lit(lo)) * F.lit(bins / (hi - lo))), F.lit(bins - 1)).cast("int")
    counted = (rows.where(v.isNotNull()).groupBy(*keys, F.when(_finite(v), idx).alias("bin"))
               .agg(F.count(F.lit(1)).alias("count")))
    # a group's bins as one map, laid out over all bins: no join, bins entries a group
    binned = F.col("bin").isNotNull()
    whole = counted.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.when(binned, F.struct("bin", "count")))).alias("_bins"),
        F.max(F.when(~binned, F.col("count"))).alias("_rest"))
    places = F.sequence(F.lit(0), F.lit(bins - 1))
    if not group:  # no rows: no bins either
        whole = whole.where((F.size("_bins") > 0) | F.col("_rest").isNotNull())
    out = whole.select(*keys, "_bins", "_rest", F.explode(F.when(F.col("_rest").isNull(), places).otherwise(
        F.concat(places, F.array(F.lit(None).cast("int"))))).alias("bin"))
    return out.select(*[F.col(k).alias(group) for k in keys], "bin",
                      (F.lit(lo) + F.col("bin") * F.lit(step)).alias("bin_lo"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(step)).alias("bin_hi"),
                      F.when(F.col("bin").isNull(), F.col("_rest"))
                      .otherwise(F.coalesce(F.try_element_at("_bins", F.col("bin")), F.lit(0))).cast("long").alias("count"))


#: Bandwidths beyond which a kernel is left out: exp(-9^2 / 2) is 2.6e-18 of its height, so a
#: density is short of the full sum by less than 2.6e-18 of the height of one kernel of its group.
KERNEL_REACH = 9


def kde(df: DataFrame, value: str, group: str, grid: int = 200, cut: float = 0.0,
        prebin: int | None = None) -> DataFrame:
    """V3: Gaussian KDE per group on ``grid`` points spanning
    [min - cut*bw, max + cut*bw] (``cut`` 0, as for the curve drawn over a
    histogram: it ends at the data), bandwidth = Scott's factor n^(-1/5) times
    the sample standard deviation. NaN and infinite values are left out.

    Data rows are first reduced to distinct (group, value, count). Each such
    row adds to the grid points within ``KERNEL_REACH`` bandwidths, whose range
    follows from the value by arithmetic, and a partial aggregate sums up per grid
    point before the shuffle. With n rows a bandwidth is n^(-1/5) standard deviations,
    so the points that a value touches become few as the data grows, whatever
    ``grid`` is. ``prebin`` bounds the work by first snapping values to the centres of
    ``prebin`` equal-width bins over the group's range (relative error about
    (bin width / bandwidth)^2 / 24, e.g. ~1e-4 for bins of bw/20); the
    default ``None`` takes the values as they are.
    """
    v = F.col("_value")
    base = df.select(F.col(group).alias("_group"), F.col(value).cast(_D).alias("_value")).where(
        F.col("_group").isNotNull() & v.isNotNull() & _finite(v))
    params = base.groupBy("_group").agg(
        F.count(F.lit(1)).cast(_D).alias("_n"), F.stddev_samp(v).alias("_sd"),
        F.min(v).alias("_min"), F.max(v).alias("_max"))
    params = (params.withColumn("_bw", F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2)))
                    .where(F.col("_bw") > 0)
                    .withColumn("_g0", F.col("_min") - cut * F.col("_bw"))
                    .withColumn("_step", (F.col("_max") - F.col("_min") + 2 * cut * F.col("_bw"))
                                / F.lit(grid - 1)))
    params, groups = materialize_summary(params)
    if prebin:
        width = (F.col("_max") - F.col("_min")) / prebin
        idx = F.least(F.floor((v - F.col("_min")) / width), F.lit(prebin - 1))
        snapped = F.when(width > 0, F.col("_min") + (idx + 0.5) * width).otherwise(v)
        vc = (attach_summary(base, params.select("_group", "_min", "_max"), "_group")
              .groupBy("_group", snapped.alias("_v")).agg(F.count(F.lit(1)).cast(_D).alias("_c")))
    else:
        vc = base.groupBy("_group", v.alias("_v")).agg(F.count(F.lit(1)).cast(_D).alias("_c"))
    small = params.select("_group", "_bw", "_g0", "_step")
    j = vc.join(F.broadcast(small) if groups <= MAX_BROADCAST_GROUPS else small, "_group")
    reach = KERNEL_REACH * F.col("_bw")
    first = F.greatest(F.lit(0), F.ceil((F.col("_v") - reach - F.col("_g0")) / F.col("_step"))).cast("int")
    last = F.least(F.lit(grid - 1), F.floor((F.col("_v") + reach - F.col("_g0")) / F.col("_step"))).cast("int")
    near = j.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
    touched = near.select("_group", F.explode(F.expr(
        "transform(sequence(_first, _last), i -> struct(i AS at, _c * exp(-0.5 * pow((_g0 + i * _step - _v) / _bw, 2)) AS k))")).alias("_t"))
    # every grid point has a row, also one that no value reaches
    points = params.select("_group", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("at"), F.lit(0.0).alias("k"))
    sums = touched.select("_group", "_t.at", "_t.k").unionByName(points).groupBy("_group", "at").agg(F.sum("k").alias("_s"))
    norm = params.select("_group", "_n", "_bw", "_g0", "_step")
    out = sums.join(F.broadcast(norm) if groups <= MAX_BROADCAST_GROUPS else norm, "_group")
    return out.select(F.col("_group").alias(group), F.col("at").alias("grid_index"),
                      (F.col("_g0") + F.col("at") * F.col("_step")).alias("x"),
                      (F.col("_s") / (F.col("_n") * F.col("_bw") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))


def scatter_bounds(df: DataFrame, real: str, predicted: str) -> DataFrame:
    """V5: axis limits of the predicted-vs-real plot and the identity line."""
    return df.agg(F.min(real).cast(_D).alias("real_min"), F.max(real).cast(_D).alias("real_max"),
                  F.min(predicted).alias("pred_min"), F.max(predicted).alias("pred_max"),
                  (F.max(real).cast(_D) * 1.1).alias("x_limit"),
                  (F.max(predicted) * 1.1).alias("y_limit"))
