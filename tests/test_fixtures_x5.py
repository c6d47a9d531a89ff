"""Statistics micro-fixtures (FIXTURES X5) and degenerate inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludica.operators import charts, clean, ml, stats
from ludica.operators.ingest import quarantine_split


def _gv(spark, rows):
    return spark.createDataFrame(rows, "g string, v double")


def test_grouped_values_edge_cases(spark):
    rows = ([("a", float(x)) for x in [1, 2, 3, 4, 10]] + [("b", float(x)) for x in [5, 5, 6, 30]]
            + [("c", 7.0)] + [("a", None)])
    df = _gv(spark, rows)
    # a group of n=1 makes Welch undefined -> NULL, no exception
    assert stats.welch_anova(df, "v", "g").first().F_statistic is None
    # Levene and Tukey still run (NULL values ignored)
    lv = stats.levene(df, "v", "g").first()
    assert lv.df1 == 2 and lv.df2 == 10 - 3
    tk = stats.tukey_hsd(df, "v", "g").collect()
    assert len(tk) == 3


def test_zero_variance_group(spark):
    df = _gv(spark, [("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 2.0), ("b", 4.0)])
    assert stats.welch_anova(df, "v", "g").first().F_statistic is None
    t = stats.welch_t_test(df, "v", F.col("g") == "a").first()
    assert t.t_statistic is not None and t.p_value is not None


def test_single_group(spark):
    df = _gv(spark, [("a", 1.0), ("a", 2.0), ("a", 4.0)])
    assert stats.welch_anova(df, "v", "g").first().F_statistic is None
    assert stats.levene(df, "v", "g").first().statistic is None
    assert stats.tukey_hsd(df, "v", "g").count() == 0


def test_two_sample_disjoint_and_exact(spark):
    rows = [("x", float(v)) for v in [1, 2, 3]] + [("y", float(v)) for v in [10, 11, 12, 13]]
    r = stats.mann_whitney(_gv(spark, rows), "v", "g", "x", "y").first()
    assert r.U_statistic == 0 and r.tie_term == 0
    assert r.P_value == pytest.approx(2 / math.comb(7, 3))      # exact, both tails
    swapped = stats.mann_whitney(_gv(spark, rows), "v", "g", "y", "x").first()
    assert swapped.U_statistic == 12 and swapped.P_value == pytest.approx(r.P_value)


def test_two_sample_heavy_ties(spark):
    rows = [("x", 1.0)] * 20 + [("x", 2.0)] * 5 + [("y", 1.0)] * 10 + [("y", 2.0)] * 15
    r = stats.mann_whitney(_gv(spark, rows), "v", "g", "x", "y").first()
    assert r.tie_term == (30 ** 3 - 30) + (20 ** 3 - 20)
    assert 0 <= r.P_value < 0.01


def test_skewed_fences(spark):
    vals = [float(x) for x in range(1, 101)] + [1e6]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    kept, fence = clean.iqr_fence(df, "v", method="exact")
    assert kept.count() == 100 and fence.upper < 1e6
    trimmed, f2 = clean.percentile_trim(df, "v", 5, 95)
    lo, hi = np.percentile(vals, [5, 95])
    assert (f2.lower, f2.upper) == pytest.approx((lo, hi))
    assert trimmed.count() == sum(lo <= v <= hi for v in vals)


def test_exact_quadratic_fit(spark):
    rows = [(x, 2 * x + 1, 3, None if x == 7 else 1) for x in range(1, 30)]
    df = spark.createDataFrame([(a, b, c, d if d is None else a * a + 5) for a, b, c, d in rows],
                               "recommendations int, negative int, peakCCU int, positive int")
    clean_df = clean.drop_nulls(df, ["recommendations", "negative", "peakCCU", "positive"])
    assert clean_df.count() == 28
    data = ml.poly_expand(ml.assemble(clean_df, ["recommendations", "negative", "peakCCU"]))
    s = ml.regression_summary(ml.fit_regression(data, "poly_features", "positive"), spark).first()
    assert s.r2 == pytest.approx(1.0, abs=1e-9) and s.mse == pytest.approx(0.0, abs=1e-6)


def test_confusion_with_class_never_predicted(spark):
    pred = spark.createDataFrame([(0, 0.0), (1, 0.0), (2, 2.0), (1, 1.0), (0, 2.0)],
                                 "label int, prediction double")
    rows = {r.label: r for r in ml.confusion(pred, [0, 1, 2], ["Low", "Medium", "High"]).collect()}
    assert rows[0].predicted_Low == 1 and rows[0].predicted_High == 1
    assert rows[2].predicted_Medium == 0 and rows[2].label_name == "High"


def test_quarantine_split(spark):
    msgs = spark.createDataFrame([('{"data":"not json"}',), ('{"data":"{\\"AppID\\":\\"9\\"}"}',)],
                                 "value string")
    good, bad = quarantine_split(msgs)
    assert [r.appID for r in good.collect()] == ["9"]
    assert [r.raw_record for r in bad.collect()] == ["not json"]


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "v double")
    h = charts.histogram(df, "v", None, 10).collect()
    counts, edges = np.histogram([3.0] * 5, bins=10)
    assert sum(r["count"] for r in h) == 5
    assert [r["count"] for r in sorted(h, key=lambda r: r.bin)] == list(counts)
