"""Top-k, overall and per group, with deterministic ties.

``top_k_per_group`` filters ``row_number() <= k``; Spark plans that as a
WindowGroupLimit, partial (before the shuffle, each task keeps k rows per
group) and final, so a group holding most of the input never moves more
than k rows per task. ``top_k`` is ORDER BY ... LIMIT k, planned as
TakeOrderedAndProject: each task keeps k rows, the merge sees tasks x k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int,
                    position: str | None = None) -> DataFrame:
    """Rows with the k best ``order`` values per ``group``. ``order`` must be
    a total order over the rows (end it with the entity key) so that ties
    are broken the same way on every run and every partitioning."""
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    rn = "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out.withColumnRenamed(rn, position) if position else out.drop(rn)


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    return df.orderBy(*_cols(order)).limit(k)
