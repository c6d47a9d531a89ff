"""Pearson correlation matrix (L2, V4) over numeric columns.

All pairs follow from one pass that keeps counts, means and co-moments of every
pair of columns (``comoments``). The wide form is pivoted over at most columns^2
rows. ``method="ml"`` uses ``Correlation.corr`` on an assembled vector column like
the analysis did; its 2-D result (columns^2 numbers) is turned back into rows
on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludica.operators.comoments import pair_rows

def corr_long(df: DataFrame, cols: Sequence[str], listwise: bool = False,
              include_diagonal: bool = False) -> DataFrame:
    """(feature_a, feature_b, r) for every pair a < b in column order.

    Pairwise deletion by default (each pair uses rows where both are set);
    ``listwise`` drops rows with any NULL among ``cols`` first.
    """
    cols = list(cols)
    if listwise:
        df = df.dropna(subset=cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + (0 if include_diagonal else 1):]]
    return pair_rows(df, pairs)


def corr_wide(df: DataFrame, cols: Sequence[str], listwise: bool = True,
              method: str | None = None) -> DataFrame:
    """The square matrix as rows: ``feature`` + one DOUBLE column per feature.

    ``sql`` (default): the upper triangle from the co-moments (pairwise
    deletion unless ``listwise``), mirrored and pivoted over at most columns^2
    rows. ``ml`` (``listwise`` only): Spark ML ``Correlation.corr`` on the
    assembled vectors; only the columns^2 matrix reaches the driver. A table
    without rows has NULL correlations in both.
    """
    cols = list(cols)
    if method is None:
        method = "sql"
    if method == "ml":
        if not listwise:
            raise ValueError("the ml method deletes rows listwise")
        return _corr_wide_ml(df, cols)
    tri = corr_long(df, cols, listwise=listwise, include_diagonal=True)
    # each triangle row also yields its mirror (one pass over ``tri``; the
    # diagonal appears twice and ``first`` takes either copy)
    fa, fb, r = F.col("feature_a"), F.col("feature_b"), F.col("r")
    mirrored = tri.select(F.inline(F.array(
        F.struct(fa.alias("feature_a"), fb.alias("feature_b"), r.alias("r")),
        F.struct(fb.alias("feature_a"), fa.alias("feature_b"), r.alias("r")))))
    wide = mirrored.groupBy(F.col("feature_a").alias("feature")).pivot("feature_b", cols) \
        .agg(F.first("r"))
    return wide.select("feature", *[F.col(c).cast("double").alias(c) for c in cols])


def _corr_wide_ml(df: DataFrame, cols: list[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    vec = VectorAssembler(inputCols=cols, outputCol="_features", handleInvalid="skip") \
        .transform(df.select(*cols)).select("_features")
    if vec.isEmpty():
        rows = [[c] + [None] * len(cols) for c in cols]
    else:
        m = Correlation.corr(vec, "_features").head()[0].toArray()
        rows = [[c] + [float(x) for x in m[i]] for i, c in enumerate(cols)]
    schema = ", ".join(["feature string"] + [f"`{c}` double" for c in cols])
    return df.sparkSession.createDataFrame(rows, schema)
