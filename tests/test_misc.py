"""Smaller inventory items: numeric selection, approximate quartiles,
vector assembly policies, accuracy, views."""

import pytest
from pyspark.sql import functions as F

from ludica.operators import clean, ml
from ludica.operators.ml import accuracy, accuracy_value
from ludica.schema import ANALYSIS_SCHEMA, LANDED_SCHEMA, numeric_columns
from ludica.sources.games import games
from tests.conftest import SF_CHECK


def test_numeric_columns_in_schema_order():
    cols = numeric_columns(ANALYSIS_SCHEMA)
    assert len(cols) == 14 and cols[0] == "peakCCU" and cols[-1] == "medianPlaytime2W"
    assert len(LANDED_SCHEMA.fields) == 41 and len(ANALYSIS_SCHEMA.fields) == 31


def test_approx_quartiles_close_to_exact(spark):
    df = clean.not_null_positive(games(spark, SF_CHECK), "averagePlaytime", cast="double")
    import math
    a = clean.iqr_bounds(df, "averagePlaytime", method="approx", relative_error=0.01)
    e = clean.iqr_bounds(df, "averagePlaytime", method="exact")
    n = df.count()
    v = F.col("averagePlaytime")
    for p, x, y in [(0.25, a.q_low, e.q_low), (0.75, a.q_high, e.q_high)]:
        target = math.ceil(p * n)                       # rank of the exact answer
        assert df.where(v < y).count() < target <= df.where(v <= y).count()
        lo, hi = df.where(v < x).count() + 1, df.where(v <= x).count()
        assert lo - 0.01 * n <= target <= hi + 0.01 * n   # GK rank guarantee


def test_assembler_policies(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert ml.assemble(df, ["a", "b"], handle_invalid="skip").count() == 1
    with pytest.raises(Exception):
        ml.assemble(df, ["a", "b"]).collect()


def test_accuracy_agrees_with_evaluator(spark):
    pred = spark.createDataFrame([(0, 0.0), (1, 1.0), (2, 1.0), (2, 2.0)], "label int, prediction double")
    assert accuracy(pred).first().accuracy == pytest.approx(accuracy_value(pred)) == 0.75


def test_inspect_and_views(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    assert q["inspect_landed"](spark, SF_CHECK).count() == 10
    q["sql_over_views"](spark, SF_CHECK)
    names = {t.name for t in spark.catalog.listTables()}
    assert {"popularity_table", "anova_platform_table", "mann_whitney_genre_table"} <= names


def test_corr_wide_ml_equals_sql(spark):
    from ludica.operators import correlation
    from ludica.plans.analyses import NUMERIC
    g = games(spark, SF_CHECK)
    a = {r.feature: r for r in correlation.corr_wide(g, NUMERIC, method="ml").collect()}
    b = {r.feature: r for r in correlation.corr_wide(g, NUMERIC, method="sql").collect()}
    for f in NUMERIC:
        assert [a[f][c] for c in NUMERIC] == pytest.approx([b[f][c] for c in NUMERIC], abs=1e-9)
