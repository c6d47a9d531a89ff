"""Grouped aggregates, ordering and top-k.

All of them are single ``groupBy().agg`` passes: partial aggregation runs
before the shuffle, so only one row per (map task, group) crosses the
network no matter how skewed the grouping key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def group_counts(df: DataFrame, group: str | Sequence[str], name: str = "count",
                 descending: bool = True) -> DataFrame:
    """Rows per group, largest first (ties by key)."""
    g = _as_list(group)
    out = df.groupBy(*g).agg(F.count(F.lit(1)).alias(name))
    if descending:
        out = out.orderBy(F.col(name).desc(), *[F.col(c).asc_nulls_last() for c in g])
    return out


def distinct_labels(df: DataFrame, group: str) -> DataFrame:
    """The distinct labels of a column."""
    return df.select(group).distinct()


def min_max(df: DataFrame, *cols: str) -> DataFrame:
    """Min and max of each column, one row."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def sort_desc(df: DataFrame, col: str, tie_break: str | None = None) -> DataFrame:
    """O1: global descending sort, NULLs last (range-partitioned, distributed)."""
    order = [F.col(col).desc_nulls_last()]
    if tie_break:
        order.append(F.col(tie_break).asc_nulls_last())
    return df.orderBy(*order)


def top_k(df: DataFrame, col: str, k: int = 10, tie_break: str | None = None) -> DataFrame:
    """O2: the k largest rows; planned as TakeOrderedAndProject (per-partition
    top-k, then a k x partitions merge), never a full sort."""
    return sort_desc(df, col, tie_break).limit(k)


# Summary tables (one row per group) at most this long are broadcast.
MAX_BROADCAST_GROUPS = 100_000
# ... and at most this long are rebuilt from their collected rows.
MAX_LOCAL_GROUPS = 10_000


def materialize_summary(summary: DataFrame,
                        max_local_rows: int = MAX_LOCAL_GROUPS) -> tuple[DataFrame, int]:
    """Materialize a per-group summary and return it with its row count.

    One job collects at most ``max_local_rows + 1`` rows. If the summary fits,
    it is rebuilt from those rows: no lineage to recompute, trivially
    broadcast. Otherwise it is checkpointed to the shared folder and counted.
    Either way the count is the size check for broadcasting it.
    """
    rows = summary.limit(max_local_rows + 1).collect()
    if len(rows) <= max_local_rows:
        return summary.sparkSession.createDataFrame(rows, summary.schema), len(rows)
    summary = summary.checkpoint(eager=True)
    return summary, summary.count()


def attach_summary(df: DataFrame, summary: DataFrame, on: str | Sequence[str],
                   max_broadcast_rows: int = MAX_BROADCAST_GROUPS) -> DataFrame:
    """Join a per-group summary (medians, quartiles, bandwidths) onto rows.

    The summary is materialized and counted first. Within the bound it is
    broadcast, so the data side is neither shuffled nor broadcast. Beyond it
    a shuffle join runs and AQE splits skewed partitions.
    """
    summary, n = materialize_summary(summary)
    small = F.broadcast(summary) if n <= max_broadcast_rows else summary
    return df.join(small, on=_as_list(on), how="inner")
