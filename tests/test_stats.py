"""Statistics on Spark vs brute-force numpy on small random frames
(unequal sizes, ties, a hot value holding a third of the rows)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludica.operators import charts, clean, stats
from ludica.operators.ranking import quantiles, running_counts, value_counts
from tools import naive_twin as N


def _frame(spark, seed, sizes=(40, 25, 9), hot=True):
    rng = np.random.default_rng(seed)
    rows = []
    for gi, n in enumerate(sizes):
        vals = rng.integers(0, 30, n).astype(float) + gi
        rows += [(f"g{gi}", float(v)) for v in vals]
    if hot:   # one value in one group: a third of all rows
        rows += [("g0", 7.0)] * (len(rows) // 2)
    import pandas as pd
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    return spark.createDataFrame(pdf), pdf


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_welch_levene_tukey(spark, seed):
    df, pdf = _frame(spark, seed)
    w = stats.welch_anova(df, "v", "g").first()
    f, p = N.welch(pdf, "v", "g")
    assert w.F_statistic == pytest.approx(f, rel=1e-9) and w.P_value == pytest.approx(p, rel=1e-6)
    lv = stats.levene(df, "v", "g").first()
    wl, pl = N.levene(pdf, "v", "g")
    assert lv.statistic == pytest.approx(wl, rel=1e-9) and lv.p_value == pytest.approx(pl, rel=1e-6)
    tk = {(r.group1, r.group2): r for r in stats.tukey_hsd(df, "v", "g").collect()}
    for g1, g2, md, padj in N.tukey(pdf, "v", "g"):
        assert tk[(g1, g2)].meandiff == pytest.approx(md, rel=1e-9, abs=1e-12)
        assert tk[(g1, g2)].p_adj == pytest.approx(padj, abs=1e-6)


def test_welch_with_two_groups_equals_t_squared(spark):
    df, pdf = _frame(spark, 5, sizes=(30, 20), hot=False)
    f = stats.welch_anova(df, "v", "g").first().F_statistic
    t = stats.welch_t_test(df, "v", F.col("g") == "g0").first().t_statistic
    assert f == pytest.approx(t * t, rel=1e-9)


@pytest.mark.parametrize("seed", [4, 5])
def test_mann_whitney_and_swap(spark, seed):
    df, pdf = _frame(spark, seed, sizes=(35, 20), hot=True)
    r = stats.mann_whitney(df, "v", "g", "g0", "g1", buckets=4).first()
    a = pdf[pdf.g == "g0"].v.to_numpy()
    b = pdf[pdf.g == "g1"].v.to_numpy()
    u, p = N.mann_whitney(a, b)
    assert r.U_statistic == pytest.approx(u) and r.P_value == pytest.approx(p, rel=1e-9)
    s = stats.mann_whitney(df, "v", "g", "g1", "g0", buckets=3).first()
    assert r.U_statistic + s.U_statistic == pytest.approx(len(a) * len(b))


def test_t_test_small_samples_note(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 3.0)], "g string, v double")
    r = stats.welch_t_test(df, "v", F.col("g") == "a").first()
    assert r.t_statistic is None and r.p_value is None and "fewer than two" in r.note


def test_degenerate_groups_give_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0), ("b", 5.0)], "g string, v double")
    assert stats.welch_anova(df, "v", "g").first().F_statistic is None   # zero variance


@pytest.mark.parametrize("buckets", [None, 1, 3, 16])
@pytest.mark.parametrize("interp", ["linear", "disc"])
def test_exact_quantiles_skewed(spark, buckets, interp):
    df, pdf = _frame(spark, 11)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    got = {r.g: r for r in quantiles(df, "v", probs, names, group="g", buckets=buckets,
                                     interpolation=interp).collect()}
    method = "linear" if interp == "linear" else "inverted_cdf"
    for g, s in pdf.groupby("g"):
        want = np.percentile(s.v.to_numpy(), [p * 100 for p in probs], method=method)
        assert [getattr(got[g], n) for n in names] == pytest.approx(list(want), abs=1e-12)


def test_running_counts_match_cumsum(spark):
    df, pdf = _frame(spark, 12)
    rc = running_counts(value_counts(df, "v"), "v", buckets=5).orderBy("v").collect()
    vals, cnt = np.unique(pdf.v.to_numpy(), return_counts=True)
    assert [r.v for r in rc] == list(vals)
    assert [r._cum for r in rc] == list(np.cumsum(cnt))


def test_downsample_exact_and_deterministic(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    a = clean.downsample(df, 1234, seed=42, key="k", edge_rows=10)
    b = clean.downsample(df.repartition(7), 1234, seed=42, key="k", edge_rows=10_000)
    ka, kb = sorted(r.k for r in a.collect()), sorted(r.k for r in b.collect())
    assert len(ka) == 1234 and ka == kb
    want = sorted(df.withColumn("h", clean.seeded_hash("k", 42)).orderBy("h", "k").limit(1234)
                  .select("k").toPandas().k)
    assert ka == want
    with pytest.raises(ValueError):
        clean.downsample(df, 6000, key="k")


@pytest.mark.parametrize("edge_rows", [0, 50, 10 ** 9])
def test_downsample_hot_and_null_keys(spark, edge_rows):
    """A third of the rows on one key, NULL keys, and whole rows repeated:
    the same rows whatever the edge size, and exactly n of them."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
                                  .otherwise(F.col("id").cast("string")).alias("k"),
                                  F.when(F.col("id") % 3 == 0, F.col("id") % 40).otherwise(F.col("id")).alias("v"))
    for n in (1, 700, 1500, 2999):
        got = sorted(map(str, clean.downsample(df, n, key="k", edge_rows=edge_rows).collect()))
        assert len(got) == n
        assert got == sorted(map(str, clean.downsample(df.repartition(5), n, key="k", edge_rows=200).collect()))


def test_null_keys_are_in_one_part_of_a_split(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), (None, 4), ("c", 5), ("d", 6)], "appID string, v int")
    a, b = clean.split(df, 0.5)
    assert sorted(r.v for r in a.unionAll(b).collect()) == [1, 2, 3, 4, 5, 6]
    assert len({r.v in {x.v for x in a.collect()} for r in df.where("appID is null").collect()}) == 1


@pytest.mark.parametrize("buckets", [None, 1, 3, 50])
def test_quantiles_keep_the_null_group(spark, buckets):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 9.0), ("b", None)], "g string, v double")
    got = {r.g: r.m for r in quantiles(df, "v", [0.5], ["m"], group="g", buckets=buckets).collect()}
    assert got == {"a": 2.0, None: 7.0}


def test_box_and_histogram_against_numpy(spark):
    df, pdf = _frame(spark, 13, hot=False)
    box = {r.g: r for r in charts.box_stats(df, "v", "g").collect()}
    for g, s in pdf.groupby("g"):
        x = np.sort(s.v.to_numpy())
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = x[(x >= lo) & (x <= hi)]
        assert (box[g].q1, box[g].median, box[g].q3) == pytest.approx((q1, med, q3))
        assert box[g].whisker_low == inside.min() and box[g].whisker_high == inside.max()
        assert box[g].n_outliers == len(x) - len(inside)
    h = charts.histogram(df, "v", None, 10).collect()
    counts, _ = np.histogram(pdf.v.to_numpy(), bins=10)
    got = [0] * 10
    for r in h:
        got[r.bin] = r["count"]
    assert got == list(counts)


def test_kde_against_numpy(spark):
    df, pdf = _frame(spark, 14, hot=False)
    k = charts.kde(df, "v", "g", grid=50).where(F.col("g") == "g1").orderBy("grid_index").collect()
    x = pdf[pdf.g == "g1"].v.to_numpy()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 50)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / bw) ** 2).sum(1) / (len(x) * bw * np.sqrt(2 * np.pi))
    assert [r.density for r in k] == pytest.approx(list(dens), rel=1e-9)


def test_kde_prebin_close_to_exact(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    exact = {(r.l_returnflag, r.grid_index): r.density for r in
             charts.kde(li, "l_extendedprice", "l_returnflag", grid=50).collect()}
    binned = {(r.l_returnflag, r.grid_index): r.density for r in
              charts.kde(li, "l_extendedprice", "l_returnflag", grid=50, prebin=2000).collect()}
    peak = max(exact.values())
    assert exact.keys() == binned.keys()
    assert max(abs(exact[k] - binned[k]) for k in exact) < 1e-3 * peak


def test_levene_mean_centre_matches_numpy(spark):
    df, pdf = _frame(spark, 21, hot=False)
    got = stats.levene(df, "v", "g", center="mean").first().statistic
    gs = {g: s.v.to_numpy() for g, s in pdf.groupby("g")}
    z = {g: np.abs(x - x.mean()) for g, x in gs.items()}
    n = np.array([len(v) for v in z.values()], float)
    zb = np.array([v.mean() for v in z.values()])
    N, k = n.sum(), len(z)
    zall = (n * zb).sum() / N
    ssw = sum(((v - v.mean()) ** 2).sum() for v in z.values())
    want = (N - k) / (k - 1) * (n * (zb - zall) ** 2).sum() / ssw
    assert got == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("interp", ["linear", "disc"])
def test_builtin_and_approx_quantile_methods(spark, interp):
    df, pdf = _frame(spark, 22)
    probs, names = [0.25, 0.5, 0.75], ["a", "b", "c"]
    exact = {r.g: r for r in quantiles(df, "v", probs, names, group="g",
                                       interpolation=interp).collect()}
    builtin = {r.g: r for r in quantiles(df, "v", probs, names, group="g", method="builtin",
                                         interpolation=interp).collect()}
    approx = {r.g: r for r in quantiles(df, "v", probs, names, group="g", method="approx",
                                        accuracy=100000).collect()}
    for g in exact:
        assert [getattr(builtin[g], n) for n in names] == pytest.approx(
            [getattr(exact[g], n) for n in names])
        if interp == "disc":   # the sketch returns data points: equal at this accuracy
            assert [getattr(approx[g], n) for n in names] == pytest.approx(
                [getattr(exact[g], n) for n in names])


def test_large_offset_means_keep_precision(spark):
    # means ~1e9 that differ by ~1: unshifted sums of squares would cancel
    rng = np.random.default_rng(3)
    rows = [(g, 1e9 + gi * 0.5 + float(x)) for gi, g in enumerate(["a", "b", "c"])
            for x in rng.normal(0, 1, 200)]
    import pandas as pd
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    df = spark.createDataFrame(pdf)
    f, _ = N.welch(pdf.assign(v=pdf.v - 1e9), "v", "g")       # exact reference on shifted data
    assert stats.welch_anova(df, "v", "g").first().F_statistic == pytest.approx(f, rel=1e-6)
    w, _ = N.levene(pdf.assign(v=pdf.v - 1e9), "v", "g")
    assert stats.levene(df, "v", "g").first().statistic == pytest.approx(w, rel=1e-6)


def test_t_statistic_changes_sign_when_samples_swap(spark):
    df, _ = _frame(spark, 31, sizes=(30, 20), hot=False)
    a = stats.welch_t_test(df, "v", F.col("g") == "g0").first()
    b = stats.welch_t_test(df, "v", F.col("g") != "g0").first()
    assert a.t_statistic == pytest.approx(-b.t_statistic)
    assert a.df == pytest.approx(b.df) and a.p_value == pytest.approx(b.p_value)


def test_tukey_only_after_significant_welch(spark):
    far = spark.createDataFrame([(g, float(v) + off) for g, off in [("a", 0.0), ("b", 50.0)]
                                 for v in range(10)], "g string, v double")
    near = spark.createDataFrame([(g, float(v)) for g in ["a", "b"] for v in range(10)],
                                 "g string, v double")
    assert stats.tukey_after_welch(far, "v", "g").count() == 1
    got = stats.tukey_after_welch(near, "v", "g")
    assert got.count() == 0 and "p_adj" in got.columns


def test_mann_whitney_names_and_nan(spark):
    rows = [("a", 1.0), ("a", 4.0), ("b", 2.0), ("b", 9.0), ("b", 9.5)]
    plain = stats.mann_whitney(spark.createDataFrame(rows, "g string, v double"), "v", "g", "a", "b").first()
    clash = stats.mann_whitney(spark.createDataFrame(rows, "_na string, _n double"), "_n", "_na", "a", "b").first()
    assert tuple(plain) == tuple(clash) and plain.U_statistic == 1.0
    nan = stats.mann_whitney(spark.createDataFrame(rows + [("b", float("nan"))], "g string, v double"), "v", "g", "a", "b").first()
    assert np.isnan(nan.U_statistic) and nan.P_value is None and nan.n_second == 4


def test_long_stream_lines_stay_whole(spark):
    from ludica.sources.messages import sse_to_messages
    line = "data: " + "x" * 3_000_000
    got = sse_to_messages(spark.createDataFrame([(line,)], "value string")).first().value
    assert len(got) == 3_000_000 + len('{"data":""}')
