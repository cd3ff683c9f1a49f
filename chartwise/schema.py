"""Schemas, the market dimension and job parameters."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Raw chart file: every column is read as text and typed later with try-casts,
# so a bad value becomes a counted reject instead of a failed job.
RAW_COLUMNS = ("date", "region", "chart", "trend", "rank", "title", "artist", "streams", "url")
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Clean fact table (one row per chart entry per day and market).
CHARTS_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("chart", T.StringType(), True),
        T.StructField("trend", T.StringType(), True),
        T.StructField("rank", T.IntegerType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("artist", T.StringType(), True),
        T.StructField("streams", T.LongType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("year", T.IntegerType(), True),
    ]
)
CHART_COLUMNS = tuple(f.name for f in CHARTS_SCHEMA.fields)

# What each column of the catalog table holds.
CHART_COMMENTS = {
    "date": "Day the entry was on the chart",
    "region": "Market: two letters if it is a known one, else the text as it came",
    "chart": "Kind of chart the entry belongs to",
    "trend": "How the entry moved since the day before",
    "rank": "Place on that day, 1 is the top",
    "title": "Name of the song",
    "artist": "Who performs it",
    "streams": "Plays counted in the market on that day",
    "url": "Where the song can be heard",
    "year": "Calendar year of date, kept for partitioning",
}

# Result sets of the three questions.
Q1_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType(), True),
        T.StructField("artist", T.StringType(), True),
        T.StructField("num_countries", T.LongType(), True),
        T.StructField("total_appearances", T.LongType(), True),
    ]
)
Q2_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("artist", T.StringType(), True),
        T.StructField("days_on_chart", T.LongType(), True),
        T.StructField("best_rank", T.IntegerType(), True),
    ]
)
Q3_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType(), True),
        T.StructField("total_streams", T.LongType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("artist", T.StringType(), True),
        T.StructField("peak_streams", T.LongType(), True),
    ]
)


@dataclass(frozen=True)
class Market:
    key: str  # lower-case name as matched against the trimmed raw region
    code: str  # two-letter code stored in the clean table
    display: str  # name shown on charts
    ordinal: int  # display order on charts


# The five markets the pipeline keeps, in chart display order
# (matched name, code, display name).
REFERENCE_MARKETS = (
    Market("vietnam", "VN", "Vietnam", 1),
    Market("south korea", "KR", "Korea", 2),
    Market("japan", "JP", "Japan", 3),
    Market("taiwan", "TW", "Taiwan", 4),
    Market("hong kong", "HK", "Hong Kong", 5),
)

# Chart kind and inclusive year range kept by ingest.
REFERENCE_CHART = "top200"
REFERENCE_YEARS = (2017, 2021)
REFERENCE_MAX_RANK = 200

# A market list up to this long is marked for broadcast; a longer one is an
# ordinary relation whose join Spark plans by size.
MAX_MARKETS = 10_000


@dataclass(frozen=True)
class IngestConfig:
    chart: str = REFERENCE_CHART
    year_from: int = REFERENCE_YEARS[0]
    year_to: int = REFERENCE_YEARS[1]
    markets: tuple[Market, ...] = field(default=REFERENCE_MARKETS)
    max_rank: int = REFERENCE_MAX_RANK
    leader_region: str = "JP"

    def __post_init__(self):
        if not self.markets:
            raise ValueError("at least one market is required")
        for what in ("key", "code"):
            if twice := [n for n, k in Counter(getattr(m, what) for m in self.markets).items() if k > 1]:
                raise ValueError(f"market {what} given more than once: {sorted(twice)}")
        if self.year_from > self.year_to:
            raise ValueError("year_from must not exceed year_to")
