"""Cleaning: normalise names, map markets to codes, type the columns, drop
incomplete and out-of-range rows. Reject counts come from one aggregate pass
(``funnel``) or from the rows that ``operators.sift`` writes, never from
repeated counts of the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwise.functions.casts import parse_once, to_chart_date, to_int_lenient, to_long_lenient
from chartwise.functions.markets import market_code, market_key
from chartwise.functions.text import normalize_name
from chartwise.operators.ingest import _as_date
from chartwise.schema import CHART_COLUMNS, IngestConfig, Market
from chartwise.sources.csv import BAD_RECORD

# The columns a chart row must have.
REQUIRED = ("title", "artist", "streams", "region", "date", "rank")


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


def normalize_region(df: DataFrame, markets: Sequence[Market]) -> DataFrame:
    """Known market names (any case, padded or not) become codes; other
    regions pass through unchanged."""
    return df.withColumn("region", market_code("region", markets))


def cast_types(df: DataFrame) -> DataFrame:
    typed = parse_once(df, rank=to_int_lenient("rank"), streams=to_long_lenient("streams"), date=to_chart_date("date"))
    return typed.withColumn("year", F.year("date"))


def drop_incomplete(df: DataFrame, subset: Sequence[str] = REQUIRED) -> DataFrame:
    return df.dropna(how="any", subset=list(subset))


def filter_valid(df: DataFrame, max_rank: int = 200) -> DataFrame:
    return df.filter((F.col("streams") > 0) & F.col("rank").between(1, max_rank))


def clean(raw: DataFrame, markets: Sequence[Market], max_rank: int = 200) -> DataFrame:
    """Raw text rows -> typed chart rows (``CHART_COLUMNS``). Permissive on
    markets: an unknown region stays as it is (market filtering is ingest's
    job), but an empty one is none: a partition folder could not tell it from
    NULL."""
    df = normalize_region(normalize_columns(raw), markets)
    df = df.withColumn("region", F.when(F.col("region") != "", F.col("region")))
    return filter_valid(drop_incomplete(cast_types(df)), max_rank).select(*CHART_COLUMNS)


def funnel(raw: DataFrame, cfg: IngestConfig) -> DataFrame:
    """One row counting the rows that survive each stage, in a single pass:
    raw -> chart kind -> chart+years+markets -> complete -> valid. If the raw
    rows carry ``BAD_RECORD``, bad records are counted too and go no further.
    Each field is parsed once."""
    rows = parse_once(raw, _day=_as_date(raw), _rank=to_int_lenient("rank"), _streams=to_long_lenient("streams"))
    day, rank, streams = F.col("_day"), F.col("_rank"), F.col("_streams")
    chart_ok = F.coalesce(F.col("chart") == F.lit(cfg.chart), F.lit(False))
    if BAD_RECORD in raw.columns:
        chart_ok = chart_ok & F.col(BAD_RECORD).isNull()
    in_years = F.coalesce(F.year(day).between(cfg.year_from, cfg.year_to), F.lit(False))
    in_markets = F.coalesce(market_key("region").isin([m.key for m in cfg.markets]), F.lit(False))
    ingested = chart_ok & in_years & in_markets
    complete = ingested & F.col("title").isNotNull() & F.col("artist").isNotNull() & streams.isNotNull() & rank.isNotNull()
    valid = complete & (streams > 0) & rank.between(1, cfg.max_rank)
    bad = [F.count(BAD_RECORD).alias("bad_records")] if BAD_RECORD in raw.columns else []
    return rows.agg(F.count(F.lit(1)).alias("raw_rows"), *bad, F.count_if(chart_ok).alias("chart_rows"), F.count_if(ingested).alias("ingested_rows"),
                    F.count_if(complete).alias("complete_rows"), F.count_if(valid).alias("clean_rows"))
