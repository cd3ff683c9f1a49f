"""Ingest: keep one chart kind, a year range and the chosen markets, tag each
row with its market code and month. Runs map-side only: the market dimension
is a bounded literal list joined by broadcast, so no shuffle is needed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwise.functions.casts import parse_once, to_chart_date
from chartwise.functions.markets import market_key, markets_frame, small
from chartwise.schema import IngestConfig, Market


def _as_date(df: DataFrame, c: str = "date"):
    """The date column as DATE: parsed when text, used as is when typed."""
    return to_chart_date(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)


def filter_chart(df: DataFrame, chart: str) -> DataFrame:
    return df.filter(F.col("chart") == F.lit(chart))


def filter_years(df: DataFrame, year_from: int, year_to: int) -> DataFrame:
    """Inclusive year range written as a date range, so that on a typed date
    column it reaches the Parquet scan as a pushed filter; rows whose date
    does not parse are dropped."""
    if isinstance(df.schema["date"].dataType, T.StringType):
        return _in_years(parse_once(df, _day=_as_date(df)), "_day", year_from, year_to).drop("_day")
    return _in_years(df, "date", year_from, year_to)


def _in_years(df: DataFrame, day: str, year_from: int, year_to: int) -> DataFrame:
    d = F.col(day)
    lo, hi = dt.date(year_from, 1, 1), dt.date(year_to + 1, 1, 1)
    return df.filter((d >= F.lit(lo)) & (d < F.lit(hi)))


def filter_markets(df: DataFrame, markets: Sequence[Market], region: str = "region") -> DataFrame:
    """Left-semi join on the (stripped, lower-cased) region against the
    market dimension."""
    m = markets_frame(df.sparkSession, markets).select("market_key")
    return df.join(small(m, markets), market_key(df[region]) == m["market_key"], "left_semi")


def lookup_market(df: DataFrame, markets: Sequence[Market], region: str = "region",
                  out: str = "country_code") -> DataFrame:
    """Inner join: keeps known markets only and adds their code."""
    m = markets_frame(df.sparkSession, markets).select("market_key", F.col("code").alias(out))
    j = df.join(small(m, markets), market_key(df[region]) == m["market_key"], "inner")
    return j.select(*[df[c] for c in df.columns], m[out])


def with_month_bucket(df: DataFrame, out: str = "month_str") -> DataFrame:
    return df.withColumn(out, F.date_format(_as_date(df), "yyyy-MM"))


def ingest(raw: DataFrame, cfg: IngestConfig) -> DataFrame:
    """Raw rows of the kept chart kind, years and markets, with their market
    code and month. The raw columns are left untouched."""
    dated = parse_once(filter_chart(raw, cfg.chart), _day=_as_date(raw))
    kept = lookup_market(_in_years(dated, "_day", cfg.year_from, cfg.year_to), cfg.markets)
    return kept.withColumn("month_str", F.date_format("_day", "yyyy-MM")).drop("_day")
