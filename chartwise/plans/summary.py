"""The answers' partial results kept at rest: a row per month, market and song.

Everything the questions ask adds up over months: appearances and streams as
sums, the best rank as a minimum, days as bits (no day is in two months), markets
as values of a column. So new days change the partials of their months alone,
and an answer reads one row per song and month instead of one per day.

``update`` reads the charts of the changed months only (a date range, which
reaches the Parquet scan) and replaces those months' folders in one commit
(dynamic partition overwrite); other months are not touched. What it writes is
complete for a month however often it runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwise.operators.topk import top_k, top_k_per_group
from chartwise.plans.questions import SONG

SUMMARY_SCHEMA = T.StructType([
    T.StructField("region", T.StringType()), T.StructField("title", T.StringType()), T.StructField("artist", T.StringType()),
    T.StructField("appearances", T.LongType()), T.StructField("days", T.LongType()), T.StructField("best_rank", T.IntegerType()),
    T.StructField("streams", T.LongType()), T.StructField("month", T.StringType())])


def month_of(date: str = "date"):
    return F.date_format(date, "yyyy-MM")


def months_in(df: DataFrame) -> list[str]:
    """The months that rows lie in: a few hundred at most, as months go."""
    return [r.month for r in df.select(month_of().alias("month")).distinct().orderBy("month").collect()]


def _bounds(month: str) -> tuple[dt.date, dt.date]:
    first = dt.date.fromisoformat(f"{month}-01")
    return first, dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)


def of_months(charts: DataFrame, months: Iterable[str]) -> DataFrame:
    """The rows of some months, as ranges of days (months in a row as one) with
    the years beside them, so that folders and files without any are left out."""
    spans: list[list[dt.date]] = []
    for lo, hi in sorted(map(_bounds, set(months))):
        if spans and spans[-1][1] == lo:
            spans[-1][1] = hi
        else:
            spans.append([lo, hi])
    if not spans:
        return charts.limit(0)
    parts = [(F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)) for lo, hi in spans]
    years = sorted({y for lo, hi in spans for y in range(lo.year, (hi - dt.timedelta(days=1)).year + 1)})
    return charts.filter(F.col("year").isin(years) & reduce(lambda a, b: a | b, parts))


def summarise(charts: DataFrame) -> DataFrame:
    """Partials of all months of ``charts``: one exchange of partial rows."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth("date"))
    return charts.groupBy("region", *SONG, month_of().alias("month")).agg(
        F.count(F.lit(1)).alias("appearances"), F.bit_or(bit).alias("days"), F.min("rank").alias("best_rank"), F.sum("streams").alias("streams")) \
        .select(*SUMMARY_SCHEMA.names)


def update(charts: DataFrame, path: str, months: Sequence[str] | None = None) -> None:
    """Write the partials of ``months`` (all that ``charts`` has, if None) over
    those at ``path``. A month without rows any more has its folder emptied."""
    spark = charts.sparkSession
    if months is None:
        summarise(charts).hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(path)
        return
    rows = summarise(of_months(charts, months)).hint("rebalance", "month")
    gone = set(months) - set(months_in(of_months(charts, months)))
    # a month that lost all rows still needs a folder of its own in the commit
    none = spark.createDataFrame([(None, None, None, 0, 0, None, 0, m) for m in sorted(gone)], SUMMARY_SCHEMA)
    rows.unionByName(none).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).parquet(path).filter(F.col("appearances") > 0)


def cross_market_hits(summary: DataFrame, min_markets: int = 3, k: int = 30) -> DataFrame:
    """Q1 from partials."""
    songs = summary.groupBy(*SONG, "region").agg(F.sum("appearances").alias("n")) \
        .groupBy(*SONG).agg(F.count("region").alias("num_countries"), F.sum("n").alias("total_appearances"))
    return top_k(songs.filter(F.col("num_countries") >= min_markets), [F.desc("num_countries"), F.desc("total_appearances"), *map(F.asc, SONG)], k)


def chart_longevity(summary: DataFrame, k: int = 5) -> DataFrame:
    """Q2 from partials."""
    songs = summary.groupBy("region", *SONG).agg(F.sum(F.bit_count("days").cast("bigint")).alias("days_on_chart"), F.min("best_rank").alias("best_rank"))
    return top_k_per_group(songs, ["region"], [F.desc("days_on_chart"), *map(F.asc, SONG)], k).orderBy("region", F.desc("days_on_chart"), *SONG)


def yearly_leader(summary: DataFrame, region: str = "JP") -> DataFrame:
    """Q3 from partials."""
    year = F.substring("month", 1, 4).cast("int")
    songs = summary.filter(F.col("region") == F.lit(region)).groupBy(year.alias("year"), *SONG).agg(F.sum("streams").alias("peak_streams"))
    lead = F.min(F.struct(F.negative("peak_streams").alias("neg"), *SONG)).alias("lead")
    years = songs.groupBy("year").agg(F.sum("peak_streams").alias("total_streams"), lead)
    return years.select("year", "total_streams", *[F.col(f"lead.{c}").alias(c) for c in SONG], F.negative("lead.neg").alias("peak_streams")).orderBy("year")
