"""Quantile sketches that are kept and merged.

A KLL sketch for each landing date (or any other key) is a few KB, whatever the
number of rows. The table of sketches is written once for the rows that arrived
and appended to by later runs; quantiles of any span of dates come from
merging its rows, without reading the data again. Ranks of the quantiles are
within ``rank_error`` of the wanted ones (with a probability of 99 %).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludica.operators.clean import Fence

SKETCH_K = 400


def rank_error(k: int = SKETCH_K) -> float:
    """Normalized rank error of both ends of a rank interval of a KLL sketch of
    size k at 99 % (the constants are those published with the sketch)."""
    return 2.446 / k ** 0.9433


def sketch_table(df: DataFrame, value: str, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One row for each key: ``by``, n (values that are neither NULL nor NaN) and their sketch."""
    v = F.col(value).cast("double")
    return (df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch")))


def merged(sketches: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Sketches merged over everything but ``by``."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles of the merged sketches as columns ``names``; NULL where nothing was counted."""
    return merged(sketches, by).select(*by, "n", *[
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(name)
        for p, name in zip(probs, names, strict=True)])


def iqr_bounds_of(sketches: DataFrame, k: float = 1.5) -> Fence:
    """Z1 bounds Q1 - k IQR and Q3 + k IQR from kept sketches."""
    row = sketch_quantiles(sketches, [0.25, 0.75], ["q1", "q3"]).first()
    if row["q1"] is None:
        return Fence(None, None, None, None)
    iqr = row["q3"] - row["q1"]
    return Fence(row["q1"] - k * iqr, row["q3"] + k * iqr, row["q1"], row["q3"])
