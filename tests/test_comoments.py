import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludica.operators import comoments, correlation, sketches

COLS = ["a", "b", "c", "_n", "m_aa"]


@pytest.fixture(scope="module")
def table(spark):
    """Offsets large against the spread, NULLs, a constant column, names that the state uses itself."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 5)) * [1, 5, 1e-3, 2, 0] + [1e6, 3, 7, -1e4, 0.1]
    x[:, 1] += x[:, 0] - 1e6
    gone = rng.random(x.shape) < [0, 0.2, 0.5, 0, 0]
    rows = [[None if g else float(v) for v, g in zip(r, gs)] for r, gs in zip(x, gone)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in COLS)).repartition(7), np.where(gone, np.nan, x)


def test_pairwise_against_numpy(table):
    df, x = table
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation.corr_long(df, COLS, include_diagonal=True).collect()}
    assert len(got) == 15
    for i, a in enumerate(COLS):
        for j, b in enumerate(COLS[i:], i):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if "m_aa" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


@pytest.mark.parametrize("method", ["sql", "ml"])
def test_wide_on_no_rows(table, method):
    df, _ = table
    for empty in (df.limit(0), df.select(F.lit(None).cast("double").alias("a"), "b").limit(5)):
        rows = correlation.corr_wide(empty, ["a", "b"], method=method).collect()
        assert [tuple(r) for r in sorted(rows)] == [("a", None, None), ("b", None, None)]


def test_nan_and_infinity_are_told(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, math.nan, 3.0), (3.0, 1.0, 4.0), (4.0, 7.0, math.inf), (None, 1.0, 1.0)],
                               "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation.corr_long(df, ["a", "b", "c"]).collect()}
    assert all(math.isnan(v) for v in got.values())
    kept = df.where(~F.isnan("b") & (F.col("c") != math.inf))
    assert {k: None if v is None else round(v, 9) for k, v in {(r[0], r[1]): r[2] for r in correlation.corr_long(kept, ["a", "b"]).collect()}.items()} \
        == {("a", "b"): -1.0}


def test_one_row_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert correlation.corr_long(df, ["a", "b"]).first()["r"] is None


def test_fit_against_least_squares(table):
    df, x = table
    full = x[~np.isnan(x[:, :3]).any(axis=1)]
    fit = {r["term"]: r for r in comoments.linear_fit(df, ["a", "c"], "b").collect()}
    design = np.c_[np.ones(len(full)), full[:, 0] - 1e6, full[:, 2]]
    want = np.linalg.lstsq(design, full[:, 1], rcond=None)[0]
    assert fit["a"]["coefficient"] == pytest.approx(want[1], rel=1e-6) and fit["c"]["coefficient"] == pytest.approx(want[2], rel=1e-6)
    assert (fit["a"]["rank"], fit["a"]["n"]) == (2, len(full))


def test_collinear_constant_and_empty(table):
    df, _ = table
    df = df.withColumn("twice", 2 * F.col("a") - 5).withColumn("sum", F.col("a") + F.col("_n"))
    fit = {r["term"]: r for r in comoments.linear_fit(df, ["a", "twice", "m_aa", "_n", "sum"], "b").collect()}
    assert {k for k, r in fit.items() if r["coefficient"] is None} == {"twice", "m_aa", "sum"}
    assert fit["a"]["rank"] == 2 and fit["a"]["coefficient"] == pytest.approx(1.0, abs=0.5)
    empty = comoments.linear_fit(df.limit(0), ["a"], "b").collect()
    assert [(r["coefficient"], r["n"], r["rank"]) for r in empty] == [(None, 0, 0)] * 2


def test_kept_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 40).alias("day"), F.when(F.col("id") % 10 > 0, F.randn(3)).alias("v"))
    kept = sketches.sketch_table(df.where("day < 20"), "v", ["day"]).unionByName(sketches.sketch_table(df.where("day >= 20"), "v", ["day"]))
    row = sketches.sketch_quantiles(kept, [0.25, 0.75], ["q1", "q3"]).first()
    assert row["n"] == df.where("v IS NOT NULL").count()
    ranks = df.where("v IS NOT NULL").agg(F.avg((F.col("v") <= row["q1"]).cast("int")), F.avg((F.col("v") <= row["q3"]).cast("int"))).first()
    assert abs(ranks[0] - 0.25) < sketches.rank_error() and abs(ranks[1] - 0.75) < sketches.rank_error()
    fence = sketches.iqr_bounds_of(kept)
    assert fence.lower < row["q1"] < row["q3"] < fence.upper
    assert sketches.iqr_bounds_of(kept.limit(0)).lower is None
