"""Data-quality gates: non-empty checks that fail a run early.

Each gate needs only to know whether a row exists; ``isEmpty`` stops at the
first row instead of counting the whole input. The report form computes one
count per check as a small aggregate (partial count per task)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    pass


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise GateError(f"{what}: 0 rows")
    return df


def quality_report(checks: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """One row per check: gate name, row count, passed flag."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("gate"), "rows")
             for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("rows") >= F.lit(min_rows))


def assert_report(report: DataFrame) -> None:
    failed = report.filter(~F.col("passed")).select("gate").collect()  # at most one row per gate
    if failed:
        raise GateError("failed gates: " + ", ".join(r.gate for r in failed))
