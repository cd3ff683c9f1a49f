"""Chart-ready rows for the three answers (the data half of each chart).

Each input is a question result, which is bounded by construction (top-k or
one row per year), so the single-partition windows used for bar positions
see at most k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartwise.functions.casts import to_int_lenient
from chartwise.functions.markets import display_name, markets_frame, small
from chartwise.functions.text import label
from chartwise.operators.topk import top_k_per_group
from chartwise.schema import Market

# Bar colour by number of markets, and the fallback colour.
MARKET_COUNT_COLORS = {3: "#A5D8FF", 4: "#339AF0", 5: "#1864AB", 6: "#003A8C", 7: "#001D4A"}
DEFAULT_COLOR = "#A5D8FF"

# Label widths (characters) and text formats of the three charts.
CROSS_MARKET_ARTIST_WIDTH = 20
CROSS_MARKET_TITLE_WIDTH = 28
CROSS_MARKET_SEPARATOR = "  -  "
LEGEND_FORMAT = "Charted in %d markets"
LONGEVITY_TITLE_WIDTH = 18
LONGEVITY_ARTIST_WIDTH = 16
BADGE_FORMAT = "#%d"
YEARLY_TITLE_WIDTH = 22
YEARLY_ARTIST_WIDTH = 18
YEARLY_SCALE = 1e9  # streams per bar unit (billions)
YEARLY_MIN_BAR = 0.3  # bars at or below this height carry no song text
BAR_TEXT_SUFFIX = "B"  # after the two-decimal value


def _color_map():
    flat = []
    for k, v in MARKET_COUNT_COLORS.items():
        flat += [F.lit(k).cast("bigint"), F.lit(v)]
    return F.create_map(*flat)


def series_cross_market(q1: DataFrame) -> DataFrame:
    """Bars of the cross-market chart: label ``artist[:20]  -  title[:28]``,
    length = appearances, colour and legend text by market count."""
    df = q1.dropna(subset=["num_countries", "total_appearances"]).withColumns({
        "num_countries": F.col("num_countries").cast("bigint"),
        "total_appearances": F.col("total_appearances").cast("bigint"),
    })
    order = Window.orderBy(F.desc("num_countries"), F.desc("total_appearances"), "title", "artist")
    return df.select(
        F.row_number().over(order).alias("position"),
        "title", "artist", "num_countries", "total_appearances",
        F.concat(label("artist", CROSS_MARKET_ARTIST_WIDTH, ascii_only=False), F.lit(CROSS_MARKET_SEPARATOR),
                 label("title", CROSS_MARKET_TITLE_WIDTH, ascii_only=False)).alias("label"),
        F.coalesce(F.try_element_at(_color_map(), F.col("num_countries")), F.lit(DEFAULT_COLOR)).alias("color"),
        F.format_string(LEGEND_FORMAT, F.col("num_countries")).alias("legend"),
    )


def series_longevity(q2: DataFrame, markets: Sequence[Market], k: int = 5, ascii_only: bool = True) -> DataFrame:
    """Small multiples: one panel per known market in display order, its top
    ``k`` songs, a two-line label and a ``#rank`` badge when rank > 0."""
    df = q2.dropna(subset=["days_on_chart"]).withColumns({
        "days_on_chart": F.col("days_on_chart").cast("bigint"),
        "best_rank": F.coalesce(to_int_lenient(F.col("best_rank").cast("string")), F.lit(0)),
        "country": display_name("region", markets),
    })
    dim = markets_frame(df.sparkSession, markets).select(F.col("display").alias("country"), "ordinal")
    panels = df.join(small(dim, markets), "country", "inner")  # markets outside the list get no panel
    top = top_k_per_group(panels, ["country"], [F.desc("days_on_chart"), "title", "artist"], k, position="position")
    return top.select(
        "ordinal", "country", "region", "position", "title", "artist", "days_on_chart", "best_rank",
        F.concat(label("title", LONGEVITY_TITLE_WIDTH, ascii_only), F.lit("\n"),
                 label("artist", LONGEVITY_ARTIST_WIDTH, ascii_only)).alias("label"),
        F.when(F.col("best_rank") > 0, F.format_string(BADGE_FORMAT, F.col("best_rank"))).alias("badge"),
    ).orderBy("ordinal", "position")


def series_yearly(q3: DataFrame, scale: float = YEARLY_SCALE, min_bar: float = YEARLY_MIN_BAR,
                  ascii_only: bool = True) -> DataFrame:
    """Bars of the yearly chart: total streams in units of ``scale`` with a
    two-decimal caption; the leading song is named only inside bars taller
    than ``min_bar``."""
    df = q3.dropna(subset=["year", "total_streams"]).withColumns({
        "year": F.col("year").cast("int"),
        "streams_b": F.col("total_streams").cast("double") / F.lit(float(scale)),
    })
    return df.select(
        "year", "total_streams", "streams_b",
        F.concat(F.expr("format_number(streams_b, '0.00')"), F.lit(BAR_TEXT_SUFFIX)).alias("bar_text"),
        F.when(F.col("streams_b") > F.lit(float(min_bar)),
               F.concat(label("title", YEARLY_TITLE_WIDTH, ascii_only), F.lit("\n"),
                        label("artist", YEARLY_ARTIST_WIDTH, ascii_only)))
        .alias("song_text"),
    ).orderBy("year")
