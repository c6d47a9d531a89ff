"""Exact quantiles by rank narrowing: the column is read a few times and never shuffled.

One pass gives each group's row count and a KLL sketch of its values. Bounds a
little before and after each wanted rank (by the sketch) cut the line into
cells, and the next pass counts the rows of every cell, which tells for certain
which cell holds the rank. While that cell is large, it is sketched and cut
again. Once few rows lie between the bounds, their values are counted one by
one, and the value at the rank is read off.

A sketch only ever proposes bounds. Ranks are located by exact counts, so a
sketch that misses costs another pass and never a wrong value. A value that
equals a bound is a cell of its own, so repeated values end the search. Every
pass is a grouped aggregate with map-side combine: what a task sends is a
row (and a sketch of a few KB) for each group and cell, at last the distinct values between the
bounds, at most ``ROWS_NEAR`` rows for each rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludica.operators.aggregate import MAX_BROADCAST_GROUPS, MAX_LOCAL_GROUPS

#: Size of the sketches, and how far around a rank (as a part of the rows) bounds are set:
#: somewhat more than the rank error of a sketch of that size, 0.4 % with a probability of 99 %.
SKETCH_K, MARGIN = 800, 0.005
#: Ranks that a sketch is asked for, evenly spaced.
STEPS = 200
#: Rows between the bounds of a rank up to which their values are counted one by one.
ROWS_NEAR = 20_000


def narrowed_quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                       group: Sequence[str] = (), interpolation: str = "linear") -> DataFrame:
    """Quantiles of the non-NULL values of each group as columns ``names``.
    NULL is a group like any other; NaN is the largest value. Columns may have any name."""
    if interpolation not in ("linear", "disc"):
        raise ValueError(f"unknown interpolation {interpolation!r}")
    keys = [f"_g{i}" for i in range(len(group))]
    rows = (df.where(F.col(value).isNotNull())
            .select(*[F.col(c).alias(k) for c, k in zip(group, keys)], F.col(value).cast("double").alias("_v")))
    ranks = [_ranks(float(p), interpolation) for p in probs]
    cells = rows.groupBy(*keys).agg(*_counted(), _sketch())
    cells = cells.select("*", F.col("_rows").alias("_total"), F.lit(0).cast("long").alias("_before"))
    while True:
        state, groups, left = _held(_located(cells, keys, ranks), len(ranks))
        if not left:
            break
        cells = _recounted(rows, state, groups, keys, len(ranks), enumerated=left <= ROWS_NEAR)
    return state.select(*[F.col(k).alias(c) for c, k in zip(group, keys)],
                        *[_interpolated(i, float(p), interpolation).alias(n) for i, (p, n) in enumerate(zip(probs, names))])


def _held(state: DataFrame, probs: int) -> tuple[DataFrame, int, int]:
    """The state as a table of its own (of few groups rebuilt from their rows, else
    checkpointed), its groups, and the most rows between the bounds of a quantile."""
    near = [f"_near{i}" for i in range(probs)]
    rows = state.limit(MAX_LOCAL_GROUPS + 1).collect()
    if len(rows) <= MAX_LOCAL_GROUPS:
        state = state.sparkSession.createDataFrame(rows, state.schema)
        return state, len(rows), max((r[c] for r in rows for c in near), default=0)
    state = state.checkpoint()
    found = state.agg(F.count(F.lit(1)).alias("n"), F.max(F.greatest(*near, F.lit(0))).alias("left")).first()
    return state, found["n"], found["left"]


def _position(p: float) -> Column:
    return (F.col("_total").cast("double") - 1) * F.lit(p)


def _ranks(p: float, interpolation: str) -> list[Column]:
    """0-based ranks that a quantile lies between, in terms of ``_total``."""
    if interpolation == "linear":
        return [F.floor(_position(p)), F.ceil(_position(p))]
    return [F.greatest(F.ceil(F.col("_total").cast("double") * F.lit(p)), F.lit(1)) - 1]


def _interpolated(i: int, p: float, interpolation: str) -> Column:
    low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
    if interpolation == "disc":
        return low
    part = _position(p) - F.floor(_position(p))
    return F.when(part == 0, low).otherwise(low + part * (high - low))


def _counted() -> list[Column]:
    return [F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_min"), F.max("_v").alias("_max")]


def _sketch() -> Column:
    return F.kll_sketch_agg_double("_v", SKETCH_K).alias("_sketch")


def _located(cells: DataFrame, keys: list[str], ranks: list[list[Column]]) -> DataFrame:
    """A row for each group, with the bounds (_low, _high) of every quantile and
    the rows expected between them; 0 where the bounds are the values at its ranks."""
    sketched = "_sketch" in cells.columns
    if sketched:
        # a sketch is asked for fixed ranks only; bounds are the nearest of them outside the margin
        steps = ", ".join(f"{i / STEPS}D" for i in range(STEPS + 1))
        cells = cells.withColumn("_steps", F.when(F.col("_min") != F.col("_max"),
                                                  F.expr(f"kll_sketch_get_quantile_double(_sketch, array({steps}))")))
    wanted = [(i, side, at) for i, pair in enumerate(ranks) for side, at in ((0, pair[0]), (1, pair[-1]))]
    rank = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), at.cast("long").alias("at"))
                               for i, side, at in wanted]))
    found = (cells.withColumn("_rank", rank)
             .where((F.col("_before") <= F.col("_rank.at")) & (F.col("_rank.at") < F.col("_before") + F.col("_rows"))))
    one, upper = F.col("_min") == F.col("_max"), F.col("_rank.side") == 1
    end = F.when(upper, F.col("_max")).otherwise(F.col("_min"))
    bound, near = end, F.when(one, 0).otherwise(F.col("_rows"))
    if sketched:  # one of up to SKETCH_K values tells nothing that the cell does not
        within = (F.col("_rank.at") - F.col("_before") + 0.5) / F.col("_rows")
        step = F.when(upper, F.ceil((within + MARGIN) * STEPS)).otherwise(F.floor((within - MARGIN) * STEPS))
        few = one | (F.col("_rows") <= SKETCH_K)
        bound = F.when(few, end).otherwise(F.get("_steps", F.least(F.greatest(step, F.lit(0)), F.lit(STEPS)).cast("int")))
        near = F.when(few, near).otherwise(F.ceil((2 * MARGIN + 1 / STEPS) * F.col("_rows")))
    found = found.select(*keys, "_total", "_rank.i", "_rank.side", bound.alias("_bound"), near.alias("_near"))

    def of(i: int, column: str, side: int) -> Column:
        return F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col(column)))
    return found.groupBy(*keys).agg(F.max("_total").alias("_total"), *[c for i in range(len(ranks)) for c in (
        of(i, "_bound", 0).alias(f"_low{i}"), of(i, "_bound", 1).alias(f"_high{i}"),
        F.greatest(of(i, "_near", 0), of(i, "_near", 1)).alias(f"_near{i}"))])


def _recounted(rows: DataFrame, state: DataFrame, groups: int, keys: list[str], probs: int, enumerated: bool) -> DataFrame:
    """The cells between all bounds, with their rows and those before them: with the values
    between two bounds as cells of their own, or else with a sketch of each cell."""
    pairs = [(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in range(probs)]
    small = state.select(*[F.col(k).alias(f"_s{k}") for k in keys], "_total", *[b for pair in pairs for b in pair])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_s{k}"))
    joined = rows.join(F.broadcast(small) if groups <= MAX_BROADCAST_GROUPS else small, same)
    v = F.col("_v")
    cell = sum(((b < v).cast("int") + (b <= v).cast("int") for pair in pairs for b in pair), F.isnan(v).cast("int"))
    if enumerated:
        near = reduce(or_, ((low < v) & (v < high) for low, high in pairs))
        cells = joined.groupBy(*keys, "_total", cell.alias("_cell"), F.when(near, v).alias("_own")).agg(*_counted())
    else:
        cells = joined.groupBy(*keys, "_total", cell.alias("_cell")).agg(*_counted(), _sketch())
    order = Window.partitionBy(*keys).orderBy("_min")
    return cells.withColumn("_before", F.sum("_rows").over(order) - F.col("_rows"))
