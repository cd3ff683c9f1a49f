"""Small summaries printed or checked along the way: counts per key, sorted
distinct values, a deterministic preview. Each is one aggregation (partial
per task before the shuffle) or a top-k, so none moves raw rows to one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, key: str, out: str = "rows") -> DataFrame:
    """Rows per key, largest first (ties by key)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), key)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def preview(df: DataFrame, cols: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows of the selected columns under a total order on them
    (equal rows are interchangeable), so every run shows the same rows."""
    return df.select(*cols).orderBy(*cols).limit(n)
