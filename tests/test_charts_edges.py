import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludica.operators import charts


def test_histogram_counts_special_values_apart(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("a", math.nan), ("a", math.inf), ("b", 4.0), ("c", -math.inf), ("b", None)],
                               "bin string, v double")
    rows = charts.histogram(df, "v", "bin", 2).collect()
    got = {(r[0], r[1]): r[4] for r in rows}
    assert got == {("a", 0): 1, ("a", 1): 1, ("a", None): 2, ("b", 0): 1, ("b", 1): 0, ("c", 0): 0, ("c", 1): 0, ("c", None): 1}
    assert {(r[2], r[3]) for r in rows} == {(0.0, 5.0), (5.0, 10.0), (None, None)}


def test_histogram_without_groups_or_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    assert [r["count"] for r in charts.histogram(df, "v", None, 3).orderBy("bin").collect()] == [1, 0, 1]
    assert charts.histogram(df.limit(0), "v", None, 3).collect() == []


def density(xs, grid):
    bw = np.std(xs, ddof=1) * len(xs) ** -0.2
    x = np.linspace(min(xs), max(xs), grid)
    return x, np.exp(-0.5 * ((x[:, None] - xs) / bw) ** 2).sum(axis=1) / (len(xs) * bw * math.sqrt(2 * math.pi)), bw


@pytest.mark.parametrize("grid", [50, 400])
def test_truncated_kernels_equal_the_full_sum(spark, grid):
    """A narrow cluster and a far value: most grid points are out of reach of most values, some of all."""
    rng = np.random.default_rng(1)
    xs = np.r_[rng.normal(size=2500), rng.normal(size=500) * 0.01 + 60, 1000.0]
    df = spark.createDataFrame([("k", float(v)) for v in xs] + [("k", math.nan), ("k", math.inf)], "_n string, _v double")
    rows = sorted(charts.kde(df, "_v", "_n", grid=grid).collect(), key=lambda r: r["grid_index"])
    x, want, bw = density(xs, grid)
    assert [r["grid_index"] for r in rows] == list(range(grid))
    assert np.allclose([r["x"] for r in rows], x)
    assert np.abs(np.array([r["density"] for r in rows]) - want).max() < 1e-15 / bw
    assert min(r["density"] for r in rows) == 0.0


def test_rows_made_do_not_follow_the_grid_step(spark):
    """What a value adds follows the bandwidth: points within reach, not the grid."""
    df = spark.range(20_000).select(F.lit("a").alias("g"), F.when(F.col("id") == 0, 1e4).otherwise(F.randn(5)).alias("v"))
    rows = charts.kde(df, "v", "g", grid=200)
    assert rows.count() == 200
