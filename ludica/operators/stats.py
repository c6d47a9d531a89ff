"""Statistical tests as Spark aggregations.

Each test reduces the data to per-group sufficient statistics in one
``groupBy().agg`` (partial aggregation before the shuffle, so group skew is
harmless), combines the k group rows algebraically in a second tiny
aggregate, and converts statistics to p-values with an Arrow UDF on the
final one-row (or one-row-per-pair) frame. No data row leaves the executors.

Degenerate inputs (fewer than two groups, a group with n < 2 or zero
variance) give NULL statistics instead of raising.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludica.functions import pvalues, special
from ludica.operators.aggregate import MAX_BROADCAST_GROUPS, attach_summary, materialize_summary
from ludica.operators.ranking import COUNT, CUM, quantiles, running_counts, value_counts

_D = "double"


def _group_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    v = F.col(value).cast(_D)
    return (df.where(F.col(group).isNotNull() & v.isNotNull())
              .groupBy(group)
              .agg(F.count(v).cast(_D).alias("n"), F.avg(v).alias("mean"),
                   F.var_samp(v).alias("var")))


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def _with_totals(summary: DataFrame, **totals: Column) -> DataFrame:
    """Attach aggregates over all rows of a summary table to each of its rows:
    the summary is materialized, its one row of totals becomes literals, and
    its rows stay where they are however many groups there are."""
    summary, _ = materialize_summary(summary)
    row = summary.agg(*[c.cast(_D).alias(name) for name, c in totals.items()]).first()
    return summary.withColumns({name: F.lit(row[name]).cast(_D) for name in totals})


# ------------------------------------------------------------------ T5 / T6

def welch_t_test(df: DataFrame, value: str, condition: Column, alpha: float = 0.05,
                 labels: Sequence[str] = ("high", "low"), with_p: bool = True) -> DataFrame:
    """Welch two-sample t-test of ``value`` where ``condition`` is true vs false.

    Rows where the condition is NULL belong to neither sample. One pass:
    conditional count/mean/variance for both samples together.
    """
    a, b = labels
    v = F.col(value).cast(_D)
    in_a, in_b = F.when(condition, v), F.when(~condition, v)
    s = df.agg(F.count(in_a).alias(f"n_{a}"), F.count(in_b).alias(f"n_{b}"),
               F.avg(in_a).alias(f"mean_{a}"), F.avg(in_b).alias(f"mean_{b}"),
               F.var_samp(in_a).alias("_va"), F.var_samp(in_b).alias("_vb"))
    na, nb = F.col(f"n_{a}").cast(_D), F.col(f"n_{b}").cast(_D)
    ok = (F.col(f"n_{a}") > 1) & (F.col(f"n_{b}") > 1)
    ea, eb = _div(F.col("_va"), na), _div(F.col("_vb"), nb)
    t = _div(F.col(f"mean_{a}") - F.col(f"mean_{b}"), F.sqrt(ea + eb))
    dof = _div((ea + eb) * (ea + eb),
               _div(ea * ea, na - 1) + _div(eb * eb, nb - 1))
    out = s.select(
        f"n_{a}", f"n_{b}", f"mean_{a}", f"mean_{b}",
        F.sqrt("_va").alias(f"sd_{a}"), F.sqrt("_vb").alias(f"sd_{b}"),
        F.when(ok, t).alias("t_statistic"), F.when(ok, dof).alias("df"),
        F.when(ok, F.lit(None).cast("string"))
         .otherwise(F.lit("a sample has fewer than two values")).alias("note"))
    if not with_p:
        return out.drop("note")
    out = out.withColumn("p_value", pvalues.t_test_p(F.col("t_statistic"), F.col("df")))
    return with_decision(out, alpha)


def with_decision(df: DataFrame, alpha: float = 0.05, p: str = "p_value") -> DataFrame:
    """Reject flag and decision for a p-value column."""
    reject = F.col(p) < F.lit(alpha)
    return (df.withColumn("reject", reject)
              .withColumn("decision",
                          F.when(reject, "difference").when(~reject, "no difference shown")))


# ----------------------------------------------------------------------- T2

def welch_anova(df: DataFrame, value: str, group: str, with_p: bool = True) -> DataFrame:
    """Welch's one-way ANOVA (unequal variances): F_statistic, df1, df2, P_value.

    With w_i = n_i / s_i^2, W = sum w_i and the weighted mean m = sum w_i m_i / W
    (totals over the k group rows), the per-group terms
    w_i (m_i - m)^2 and (1 - w_i / W)^2 / (n_i - 1) are summed directly - no
    expanded sums that cancel when one group's weight dominates.
    """
    n, m, var = F.col("n"), F.col("mean"), F.col("var")
    st = _group_stats(df, value, group).withColumn("_w", _div(n, var))
    st = _with_totals(st, _wsum=F.sum("_w"), _wm=F.sum(F.col("_w") * m))
    st = st.withColumn("_mbar", _div(F.col("_wm"), F.col("_wsum")))
    s = st.agg(
        F.count(F.lit(1)).cast(_D).alias("k"),
        F.sum(F.col("_w") * (m - F.col("_mbar")) * (m - F.col("_mbar"))).alias("_ssb"),
        F.sum(_div((1 - F.col("_w") / F.col("_wsum")) * (1 - F.col("_w") / F.col("_wsum")),
                   n - 1)).alias("_lam"),
        F.bool_and((n > 1) & (var > 0)).alias("_valid"))
    k, lam = F.col("k"), F.col("_lam")
    a = _div(F.col("_ssb"), k - 1)
    f = _div(a, 1 + 2 * (k - 2) * _div(lam, k * k - 1))
    ok = F.col("_valid") & (k >= 2)
    out = s.select(F.when(ok, f).alias("F_statistic"), F.when(ok, k - 1).alias("df1"),
                   F.when(ok, _div(k * k - 1, 3 * lam)).alias("df2"))
    if with_p:
        out = out.withColumn("P_value", pvalues.f_test_p(F.col("F_statistic"), F.col("df1"),
                                                         F.col("df2")))
    return out


# ----------------------------------------------------------------------- T1

def levene(df: DataFrame, value: str, group: str, center: str = "median",
           with_p: bool = True) -> DataFrame:
    """Levene / Brown-Forsythe test of equal variances (default: median centre).

    Medians come from rank narrowing, the distances from them are a second
    grouped aggregate over the rows: neither shuffles the column.
    """
    # own names: the table may have columns called like the statistics
    base = df.where(F.col(group).isNotNull()).select(F.col(group).alias("_group"), F.col(value).cast(_D).alias("_value"))
    if center == "median":
        centre = quantiles(base, "_value", [0.5], ["_c"], "_group")
    elif center == "mean":
        centre = base.groupBy("_group").agg(F.avg("_value").alias("_c"))
    else:
        raise ValueError(f"unknown centre {center!r}")
    z = F.abs(F.col("_value") - F.col("_c"))
    zs = (attach_summary(base.where(F.col("_value").isNotNull()), centre, "_group").groupBy("_group")
          .agg(F.count(F.lit(1)).cast(_D).alias("n"), F.avg(z).alias("mean"), F.var_samp(z).alias("var")))
    n, zbar = F.col("n"), F.col("mean")
    # overall mean of z over the k group rows, then direct per-group terms
    zs = _with_totals(zs, _zsum=F.sum(n * zbar), _nsum=F.sum(n))
    zs = zs.withColumn("_zall", _div(F.col("_zsum"), F.col("_nsum")))
    s = zs.agg(F.count(F.lit(1)).cast(_D).alias("k"), F.sum(n).alias("N"),
               F.sum(n * (zbar - F.col("_zall")) * (zbar - F.col("_zall"))).alias("SSB"),
               F.sum(F.coalesce((n - 1) * F.col("var"), F.lit(0.0))).alias("SSW"))
    k, N = F.col("k"), F.col("N")
    w = _div((N - k) * F.col("SSB"), (k - 1) * F.col("SSW"))
    ok = (k >= 2) & (N > k)
    out = s.select(F.when(ok, w).alias("statistic"), F.when(ok, k - 1).alias("df1"),
                   F.when(ok, N - k).alias("df2"))
    if with_p:
        out = out.withColumn("p_value", pvalues.f_test_p(F.col("statistic"), F.col("df1"),
                                                         F.col("df2")))
    return out


# ----------------------------------------------------------------------- T3

def tukey_hsd(df: DataFrame, value: str, group: str, alpha: float = 0.05,
              with_p: bool = True) -> DataFrame:
    """Tukey-Kramer pairwise comparison of group means.

    The result is one row per pair of *groups*; the pairs come from a self
    join of the k-row statistics table on ``group1 < group2`` (broadcast where
    the counted size allows it) and are dealt over the shuffle partitions
    before their p-values are computed. Data rows are only touched by the
    first aggregate. Tails and limits come from ``with_range_tail``, so the
    quadratures don't grow with the pairs.
    """
    st, k = materialize_summary(_group_stats(df, value, group))
    st = _with_totals(st, _N=F.sum("n"), _k=F.count(F.lit(1)), _ssw=F.sum((F.col("n") - 1) * F.col("var")))
    st = st.withColumn("_mse", _div(F.col("_ssw"), F.col("_N") - F.col("_k")))
    a = st.select(F.col(group).alias("group1"), F.col("n").alias("_n1"),
                  F.col("mean").alias("_m1"), "_N", "_k", "_mse")
    b = st.select(F.col(group).alias("group2"), F.col("n").alias("_n2"), F.col("mean").alias("_m2"))
    pairs = (a.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "group1")
              .join(F.broadcast(b) if k <= MAX_BROADCAST_GROUPS else b, F.col("group1") < F.col("group2"), "inner"))
    meandiff = F.col("_m2") - F.col("_m1")
    se = F.sqrt(F.col("_mse") / 2 * (1 / F.col("_n1") + 1 / F.col("_n2")))
    out = pairs.select("group1", "group2", meandiff.alias("meandiff"),
                       _div(F.abs(meandiff), se).alias("q"), se.alias("_se"),
                       "_k", (F.col("_N") - F.col("_k")).alias("_df"))
    if not with_p:
        return out.drop("_se", "_k", "_df")
    out = with_range_tail(out, alpha)
    return out.select("group1", "group2", "meandiff", "q", "p_adj",
                      (F.col("meandiff") - F.col("_qc") * F.col("_se")).alias("lower"),
                      (F.col("meandiff") + F.col("_qc") * F.col("_se")).alias("upper"),
                      (F.col("p_adj") < F.lit(alpha)).alias("reject"))


def with_range_tail(pairs: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``p_adj`` = P(Q > q) and ``_qc``, the critical value, for rows with q, _k, _df.

    The tail is a table: log(1 + q) falls into a cell of fixed width, each
    distinct (cell, _k, _df) is fitted once by quadrature, and its polynomial
    is joined to the rows and evaluated by column expressions (error below
    1e-9). A (_k, _df) has at most RANGE_CELLS * log(largest double) cells,
    about 22,700, however many rows there are: so the table is broadcast where
    it holds one (_k, _df), as it does for the pairs of one comparison.
    """
    x = F.log1p("q") * special.RANGE_CELLS
    pairs = pairs.withColumn("_cell", F.coalesce(F.floor(x).cast("int"), F.lit(-1)))
    keys = ["_cell", "_k", "_df"]
    cells = pairs.select(*keys).distinct()
    cells, n = materialize_summary(cells.select(
        *[F.col(c).alias(f"_t{c}") for c in keys], pvalues.tukey_cell("_cell", "_k", "_df").alias("_poly"),
        pvalues.tukey_qcrit(F.lit(alpha), F.col("_k"), F.col("_df")).alias("_qc")))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_t{c}"))
    out = pairs.join(F.broadcast(cells) if n <= MAX_BROADCAST_GROUPS else cells, same, "left")
    u, p = (x - F.col("_cell")) * 2 - 1, F.lit(0.0)
    for i in reversed(range(special.RANGE_POINTS)):
        p = p * u + F.col("_poly")[i]
    return (out.withColumn("p_adj", F.when(p.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))))
            .drop("_poly", "_cell", *[f"_t{c}" for c in keys]))


# ----------------------------------------------------------------------- T4

def mann_whitney(df: DataFrame, value: str, group: str, first: str, second: str,
                 with_p: bool = True, buckets: int | None = None) -> DataFrame:
    """Mann-Whitney U of ``first`` vs ``second`` (U for the first sample).

    Midranks come from running counts over the distinct values of both
    samples together (``ranking.running_counts``: value-range buckets, so no
    single task ranks everything); R_first = sum(count_first(v) * midrank(v)).
    The tie correction sum(t^3 - t) is a plain aggregate in DOUBLE. A NaN has
    no rank: with one among the values, U is NaN and the p-value NULL.
    """
    # own names: the table may have columns called like the counts
    two = (df.where(F.col(group).isin(first, second) & F.col(value).isNotNull())
           .select(F.col(group).alias("_group"), F.col(value).alias("_value")))
    vc = two.groupBy("_value").agg(
        F.count(F.lit(1)).alias(COUNT),
        F.sum(F.when(F.col("_group") == first, 1).otherwise(0)).alias("_na"))
    rc = running_counts(vc, "_value", buckets=buckets)
    t = F.col(COUNT).cast(_D)
    midrank = F.col(CUM).cast(_D) - (t - 1) / 2
    s = rc.agg(F.sum(F.col("_na").cast(_D) * midrank).alias("_ra"),
               F.sum("_na").cast(_D).alias("_n1"), F.sum(COUNT).cast(_D).alias("_n"),
               F.sum(t * t * t - t).alias("tie_term"), F.max(F.isnan(F.col("_value").cast(_D))).alias("_nan"))
    n1 = F.col("_n1")
    n2 = F.col("_n") - n1
    u1 = F.when(F.col("_nan"), F.lit(float("nan"))).otherwise(F.col("_ra") - n1 * (n1 + 1) / 2)
    out = s.select(u1.alias("U_statistic"), n1.cast("long").alias("n_first"),
                   n2.cast("long").alias("n_second"), F.col("tie_term"))
    if with_p:
        out = out.withColumn("P_value", F.when(~F.isnan("U_statistic"), pvalues.mwu_p(
            F.nanvl("U_statistic", F.lit(0.0)), F.col("n_first"), F.col("n_second"), F.col("tie_term"))))
    return out


#: Samples of together at most this many values have an exact p-value.
EXACT_ITEMS = 100
#: A stratum of at most this many rows (not below EXACT_ITEMS) is ranked within one task.
SMALL_STRATUM = 10_000


def mann_whitney_by(df: DataFrame, value: str, group: str, first: str, second: str, by: Sequence[str]) -> DataFrame:
    """T4 within each stratum: one row per distinct ``by`` (NULL is a stratum).

    A first job counts the rows of the strata. Those of at most
    ``SMALL_STRATUM`` rows are dealt over the shuffle partitions once, then
    counted, ranked and tested there; larger ones (few: at most one for so many
    rows) are ranked together by ``running_counts``, by stratum and value range,
    so neither a large stratum nor a frequent value sits in one task.
    A stratum of at most ``EXACT_ITEMS`` values keeps the running counts of its
    tie groups and gets the exact p-value given these ties (``method`` exact:
    twice the smaller tail); a larger one gets the p-value of ``mann_whitney``
    (exact without ties and with a sample of at most 8, else asymptotic). A
    stratum without one of the samples, or with a NaN, has NULL ``P_value``.
    """
    # own names: the table may have columns called like the counts
    keys = [f"_by{i}" for i in range(len(by))]
    two = (df.where(F.col(group).isin(first, second) & F.col(value).isNotNull())
           .select(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.col(group).alias("_group"),
                   F.col(value).cast(_D).alias("_value")))
    large = two.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT)).where(F.col(COUNT) > SMALL_STRATUM)
    large, n = materialize_summary(large.select(*[F.col(k).alias(f"_large{k}") for k in keys]))
    small, parts = two, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_large{k}"))
        large = F.broadcast(large) if n <= MAX_BROADCAST_GROUPS else large
        small = two.join(large, same, "left_anti")
    counts = [F.count(F.lit(1)).alias(COUNT), F.sum(F.when(F.col("_group") == first, 1).otherwise(0)).alias("_na")]
    upto = Window.partitionBy(*keys).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    s = _rank_sums(small.repartition(parts, *keys).groupBy(*keys, "_value").agg(*counts)
                   .withColumn(CUM, F.sum(COUNT).over(upto)), keys)
    if n:
        vc = two.join(large, same, "left_semi").groupBy(*keys, "_value").agg(*counts)
        s = s.unionByName(_rank_sums(running_counts(vc, "_value", keys), keys, listed=False))
    n1 = F.col("n_first").cast(_D)
    both = (F.col("n_first") > 0) & (F.col("n_second") > 0) & ~F.col("_nan")
    listed = F.col("_cums").isNotNull()
    exact = listed | ((F.col("tie_term") == 0) & (F.least("n_first", "n_second") <= 8))
    s = s.withColumn("U_statistic", F.when(both, F.col("_ra") - n1 * (n1 + 1) / 2))
    # each row has its value from one of the two: a Python function is run for every row, whatever coalesce needs
    p = F.coalesce(pvalues.mwu_tied_p("U_statistic", "n_first", "n_second", "_cums"),
                   pvalues.mwu_p(F.when(~listed, F.col("U_statistic")), "n_first", "n_second", "tie_term"))
    return s.select(*[F.col(k).alias(b) for b, k in zip(by, keys)], "U_statistic", "n_first", "n_second", "tie_term",
                    p.alias("P_value"), F.when(both, F.when(exact, "exact").otherwise("asymptotic")).alias("method"))


def _rank_sums(ranked: DataFrame, keys: Sequence[str], listed: bool = True) -> DataFrame:
    """Rank sum, sizes and tie term of each stratum; with ``listed`` the running
    counts of its tie groups (``_cums``) if it has at most ``EXACT_ITEMS`` values."""
    t = F.col(COUNT).cast(_D)
    midrank = F.col(CUM).cast(_D) - (t - 1) / 2
    # the last running count is the number of values, so a count above the bound means that nothing is listed
    cums = F.array_sort(F.collect_list(F.when(F.col(CUM) <= EXACT_ITEMS, F.col(CUM))))
    s = ranked.groupBy(*keys).agg(
        F.sum(F.col("_na").cast(_D) * midrank).alias("_ra"), F.sum("_na").alias("n_first"),
        (F.sum(COUNT) - F.sum("_na")).alias("n_second"), F.sum(t * t * t - t).alias("tie_term"),
        F.max(F.isnan("_value")).alias("_nan"), *([cums.alias("_cums")] if listed else []))
    whole = F.col("n_first") + F.col("n_second") <= EXACT_ITEMS
    return s.withColumn("_cums", F.when(whole, F.col("_cums")) if listed else F.lit(None).cast("array<bigint>"))


def tukey_after_welch(df: DataFrame, value: str, group: str,
                      alpha: float = 0.05) -> DataFrame:
    """T2 -> T3 as the analysis chains them: the Tukey comparison only when
    Welch's ANOVA rejects at ``alpha``; otherwise an empty frame of the same
    schema. One small job decides (the one-row ANOVA result)."""
    anova = welch_anova(df, value, group).first()
    pairs = tukey_hsd(df, value, group, alpha=alpha)
    p = anova.P_value if anova is not None else None
    if p is not None and p < alpha:
        return pairs
    return pairs.limit(0)
