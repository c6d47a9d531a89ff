"""Property tests: exact quantiles and Mann-Whitney U on random frames with
random skew and bucket counts, against numpy / brute force."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ludica.operators import stats
from ludica.operators.ranking import quantiles

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60)


@SETTINGS
@given(a=values, b=values, hot=st.integers(0, 40), buckets=st.sampled_from([None, 1, 2, 5]),
       p=st.floats(0.0, 1.0))
def test_quantiles_match_numpy(spark, a, b, hot, buckets, p):
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("a", 0.0)] * hot
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["g", "v"]))
    got = {r.g: r for r in quantiles(df, "v", [p], ["q"], group="g", buckets=buckets).collect()}
    got_d = {r.g: r for r in quantiles(df, "v", [p], ["q"], group="g", buckets=buckets,
                                       interpolation="disc").collect()}
    for g, xs in (("a", a + [0] * hot), ("b", b)):
        arr = np.array(xs, dtype=float)
        assert got[g].q == pytest.approx(np.percentile(arr, p * 100), abs=1e-9)
        assert got_d[g].q == pytest.approx(np.percentile(arr, p * 100, method="inverted_cdf"))


@SETTINGS
@given(a=values, b=values, buckets=st.sampled_from([None, 1, 3]))
def test_mann_whitney_matches_brute_force(spark, a, b, buckets):
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["g", "v"]))
    r = stats.mann_whitney(df, "v", "g", "a", "b", buckets=buckets).first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)   # definition of U
    assert r.U_statistic == pytest.approx(u)
    s = stats.mann_whitney(df, "v", "g", "b", "a", buckets=buckets).first()
    assert r.U_statistic + s.U_statistic == pytest.approx(len(a) * len(b))
    assert 0.0 <= r.P_value <= 1.0 and r.P_value == pytest.approx(s.P_value)


groups = st.lists(st.lists(st.floats(-1e3, 1e3, allow_nan=False, width=32), min_size=3, max_size=25),
                  min_size=2, max_size=4)


@SETTINGS
@given(gs=groups)
def test_welch_levene_ttest_match_numpy(spark, gs):
    from pyspark.sql import functions as F

    from tools import naive_twin as N
    rows = [(f"g{i}", float(x)) for i, xs in enumerate(gs) for x in xs]
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    df = spark.createDataFrame(pdf)
    var_ok = all(np.var(np.array(xs, float), ddof=1) > 1e-9 for xs in gs)
    w = stats.welch_anova(df, "v", "g").first()
    if var_ok:
        f, p = N.welch(pdf, "v", "g")
        assert w.F_statistic == pytest.approx(f, rel=1e-6, abs=1e-9)
        assert w.P_value == pytest.approx(p, rel=1e-5, abs=1e-12)
    else:
        assert w.F_statistic is None
    z_ok = any(np.var(np.abs(np.array(xs, float) - np.median(xs)), ddof=1) > 1e-9 for xs in gs)
    if z_ok:
        lv = stats.levene(df, "v", "g").first()
        wl, _ = N.levene(pdf, "v", "g")
        assert lv.statistic == pytest.approx(wl, rel=1e-6, abs=1e-9)
    if var_ok:
        t = stats.welch_t_test(df, "v", F.col("g") == "g0").first()
        a = np.array(gs[0], float)
        b = np.concatenate([np.array(x, float) for x in gs[1:]])
        tt, dd, pp = N.welch_t(a, b)
        assert t.t_statistic == pytest.approx(tt, rel=1e-6, abs=1e-9)
        assert t.df == pytest.approx(dd, rel=1e-6)
