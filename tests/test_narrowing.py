"""Rank narrowing against numpy: every size of sketch and of the counted rest gives the same values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludica.operators import charts, narrowing, stats
from ludica.operators.ranking import quantiles

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
NAMES = [f"p{i}" for i in range(len(PROBS))]


def groups():
    rng = random.Random(5)
    return {"normal": [rng.gauss(0, 1) for _ in range(6000)], "two": [0.0] * 3000 + [1.0] * 3000, "one": [4.0] * 50,
            "single": [2.5], "pair": [1.0, 2.0], "heavy": [rng.paretovariate(0.3) for _ in range(4000)],
            "ties": [float(rng.randrange(5)) for _ in range(5000)], None: [float(i) for i in range(999)],
            "huge": [1e300 * rng.random() for _ in range(700)] + [math.inf, -math.inf]}


@pytest.fixture(scope="module")
def table(spark):
    rows = [(g, v, 0) for g, values in groups().items() for v in values] + [("normal", None, 0), ("none", None, 0)]
    return spark.createDataFrame(rows, "g string, v double, _n int").repartition(5)


@pytest.mark.parametrize("near, k, margin", [(20_000, 800, 0.005), (40, 8, 0.02)])
@pytest.mark.parametrize("interpolation", ["linear", "disc"])
def test_against_numpy(table, monkeypatch, near, k, margin, interpolation):
    """Coarse sketches, bounds that miss, and rests that take several passes."""
    monkeypatch.setattr(narrowing, "ROWS_NEAR", near)
    monkeypatch.setattr(narrowing, "SKETCH_K", k)
    monkeypatch.setattr(narrowing, "MARGIN", margin)
    got = {r["g"]: r for r in quantiles(table, "v", PROBS, NAMES, "g", interpolation=interpolation).collect()}
    assert set(got) == set(groups())
    for g, values in groups().items():
        if g == "huge" and interpolation == "linear":
            continue  # numpy interpolates infinities to NaN
        want = np.percentile(values, [100 * p for p in PROBS], method="linear" if interpolation == "linear" else "inverted_cdf")
        assert [got[g][n] for n in NAMES] == pytest.approx(list(want), rel=1e-12), g


def test_no_group_and_no_rows(table):
    values = [v for vs in groups().values() for v in vs if math.isfinite(v)]
    finite = table.where(F.abs("v") < float("inf"))
    assert quantiles(finite, "v", [0.3], ["q"]).first()["q"] == pytest.approx(np.percentile(values, 30))
    assert quantiles(finite.limit(0), "v", [0.3], ["q"], "g").collect() == []
    assert quantiles(finite.limit(0), "v", [0.3], ["q"]).first()["q"] is None


def test_nan_is_the_largest(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,), (float("nan"),)], "v double")
    r = quantiles(df, "v", [0.0, 0.3, 1.0], ["a", "b", "c"], interpolation="disc").first()
    assert (r["a"], r["b"]) == (1.0, 2.0) and math.isnan(r["c"])


def test_names_that_clash(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("b", 9.0), ("b", 10.0)], "_n string, _v double")
    assert {r["_n"]: r["_rows"] for r in quantiles(df, "_v", [0.5], ["_rows"], "_n").collect()} == {"a": 1.5, "b": 9.0}
    plain = df.toDF("g", "v")
    for a, b in ((stats.levene(df, "_v", "_n"), stats.levene(plain, "v", "g")),
                 (charts.box_stats(df, "_v", "_n"), charts.box_stats(plain, "v", "g"))):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_the_column_is_not_shuffled(spark):
    """What the passes send is bounded by groups, cells and the rows near a rank."""
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.randn(1).alias("v"))
    keys = ["_g0"]
    rows = df.select(F.col("g").alias("_g0"), F.col("v").alias("_v"))
    first = rows.groupBy(*keys).agg(*narrowing._counted(), narrowing._sketch()).selectExpr("*", "_rows _total", "0L _before")
    state, n, left = narrowing._held(narrowing._located(first, keys, [narrowing._ranks(0.5, "linear")]), 1)
    assert 0 < left < 0.02 * 200_000
    cells = narrowing._recounted(rows, state, n, keys, 1, enumerated=True)
    assert cells.count() < 0.02 * 200_000
    assert cells.agg(F.sum("_rows")).first()[0] == 200_000


def test_whiskers_beside_nan(spark):
    df = spark.createDataFrame([("a", float(x)) for x in range(20)] + [("a", float("nan"))], "g string, v double")
    r = charts.box_stats(df, "v", "g").first()
    assert (r["whisker_low"], r["whisker_high"], r["n_outliers"]) == (0.0, 19.0, 1)
