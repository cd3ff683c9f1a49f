"""The three questions over clean charts. A song is (title, artist) unless
other entity keys are passed as ``song``.

Every ranking ends with ``title, artist`` ascending so that equal counts are
ordered the same way on every run (the original SQL had no tie-breaker).

Scale notes
  * All aggregates are algebraic, so each shuffle carries partial results
    (one row per key per task), never raw rows: a song or market holding a
    third of the input costs no more shuffle than any other key.
  * Distinct counts are sets of bits where the values are known beforehand
    (markets, days of known years), merged in one exchange; otherwise two-level
    group-bys (key+value, then key), the shape Spark uses for a single
    distinct aggregate, written out so that both levels carry their other
    aggregates along.
  * Per-group top-k is a WindowGroupLimit (k rows per task and group before
    the shuffle); global top-k is TakeOrderedAndProject.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartwise.operators.topk import top_k, top_k_per_group

SONG = ("title", "artist")


def cross_market_hits(charts: DataFrame, min_markets: int = 3, k: int = 30,
                      market: str = "region", song: Sequence[str] = SONG, known_markets: Sequence[str] | None = None) -> DataFrame:
    """Songs charting in at least ``min_markets`` markets, most markets first,
    then most appearances; ``k`` rows.

    If the markets in the data are known to be among ``known_markets`` (at most
    63), one aggregation does: each market is a bit, and a song's markets
    are the bits set. Otherwise markets are counted in two steps."""
    if known_markets is not None and len(known_markets) <= 63:
        bit = F.lit(None).cast("bigint")
        for i, code in enumerate(sorted(set(known_markets))):
            bit = F.when(F.col(market) == F.lit(code), F.lit(1 << i).cast("bigint")).otherwise(bit)
        other = F.when(F.col(market).isNotNull() & bit.isNull(), F.raise_error(F.concat(F.lit("unknown market: "), F.col(market))).cast("bigint"))
        songs = charts.groupBy(*song).agg(F.bit_or(F.coalesce(bit, other, F.lit(0).cast("bigint"))).alias("bits"), F.count("*").alias("total_appearances"))
        hits = songs.select(*song, F.bit_count("bits").cast("bigint").alias("num_countries"), "total_appearances") \
            .filter(F.col("num_countries") >= min_markets)
        return top_k(hits, [F.desc("num_countries"), F.desc("total_appearances"), *[F.asc(c) for c in song]], k)
    per_market = charts.groupBy(*song, market).agg(F.count(F.lit(1)).alias("n"))
    songs = per_market.groupBy(*song).agg(
        F.count(market).alias("num_countries"),  # non-NULL markets = COUNT(DISTINCT market)
        F.sum("n").alias("total_appearances"),
    )
    hits = songs.filter(F.col("num_countries") >= min_markets)
    return top_k(hits, [F.desc("num_countries"), F.desc("total_appearances"), *[F.asc(c) for c in song]], k)


#: Days of a year that one BIGINT holds as bits, and years up to which a song's days are kept so.
DAYS_A_WORD, MOST_YEARS = 61, 20


def day_words(years: tuple[int, int], date: str = "date") -> dict[str, Column]:
    """The set of days of a group of rows as aggregates: for each year six
    BIGINTs of up to 61 days each. Such sets merge by OR, and being of fixed size
    they do so in the tasks that read the rows."""
    day, bit = F.dayofyear(date) - 1, F.lit(1).cast("bigint")
    word = F.floor(day / DAYS_A_WORD).cast("int")
    mask = F.when(F.col(date).isNotNull(), F.call_function("shiftleft", bit, (day % DAYS_A_WORD).cast("int")))
    return {f"days_{y}_{w}": F.bit_or(F.when((F.year(date) == y) & (word == w), mask).otherwise(F.lit(0).cast("bigint")))
            for y in range(years[0], years[1] + 1) for w in range(-(-366 // DAYS_A_WORD))}


def _all_days_known(known_years: tuple[int, int] | None) -> bool:
    return known_years is not None and known_years[1] - known_years[0] < MOST_YEARS


def chart_longevity(charts: DataFrame, k: int = 5, market: str = "region",
                    song: Sequence[str] = SONG, known_years: tuple[int, int] | None = None) -> DataFrame:
    """Per market, the ``k`` songs with the most distinct chart days, with
    their best (lowest) rank.

    If all dates are known to lie in ``known_years`` (inclusive, at most
    ``MOST_YEARS``), a song's days are bits of a few numbers, and one exchange of
    a row per song and task does: nearly every day of a song is a row of its
    own, so an exchange by song and day would move the whole table. Other dates
    end the query. Without known years days are counted in two steps."""
    if _all_days_known(known_years):
        words = day_words(known_years)
        outside = F.max(F.when(F.col("date").isNotNull() & ~F.year("date").between(*known_years),
                               F.raise_error(F.concat(F.lit("date out of the known years: "), F.col("date").cast("string"))).cast("int")))
        sets = charts.groupBy(market, *song).agg(*[e.alias(n) for n, e in words.items()], F.min("rank").alias("best_rank"), outside.alias("outside"))
        days = reduce(lambda a, b: a + b, [F.bit_count(n) for n in words]).cast("bigint")
        songs = sets.filter(F.col("outside").isNull()).select(market, *song, days.alias("days_on_chart"), "best_rank")
        top = top_k_per_group(songs, [market], [F.desc("days_on_chart"), *[F.asc(c) for c in song]], k)
        return top.orderBy(market, F.desc("days_on_chart"), *song)
    per_day = charts.groupBy(market, *song, "date").agg(F.min("rank").alias("day_best"))
    songs = per_day.groupBy(market, *song).agg(
        F.count("date").alias("days_on_chart"),  # non-NULL dates = COUNT(DISTINCT date)
        F.min("day_best").alias("best_rank"),
    )
    top = top_k_per_group(songs, [market], [F.desc("days_on_chart"), *[F.asc(c) for c in song]], k)
    return top.orderBy(market, F.desc("days_on_chart"), *song)


def song_year_totals(charts: DataFrame, region: str, song: Sequence[str] = SONG) -> DataFrame:
    """Yearly stream sum per song in one market (named ``peak_streams``: it
    is the song's best yearly total, the value that picks the leader)."""
    return (charts.filter(F.col("region") == F.lit(region))
            .groupBy("year", *song).agg(F.sum("streams").alias("peak_streams")))


def yearly_totals(charts: DataFrame, region: str) -> DataFrame:
    return (charts.filter(F.col("region") == F.lit(region))
            .groupBy("year").agg(F.sum("streams").alias("total_streams")))


def yearly_leader(charts: DataFrame, region: str = "JP", song: Sequence[str] = SONG) -> DataFrame:
    """Per year in one market: total streams and the most-streamed song.

    One scan and two aggregations: song totals per year, then per year the
    sum of those and the minimum of (-song total, title, artist), which is
    the leader under the tie rule. Both aggregates combine map-side, so a
    year holding most rows is no hotter than the others.
    """
    songs = song_year_totals(charts, region, song)
    per_year = songs.groupBy("year").agg(
        F.sum("peak_streams").alias("total_streams"),
        F.min(F.struct(F.negative("peak_streams").alias("neg"), *song)).alias("lead"),
    )
    return (per_year.select("year", "total_streams", *[F.col(f"lead.{c}").alias(c) for c in song],
                            F.negative("lead.neg").alias("peak_streams"))
            .orderBy("year"))


def yearly_leader_join(charts: DataFrame, region: str = "JP", song: Sequence[str] = SONG) -> DataFrame:
    """The same answer in the two-branch shape: per-year totals joined on
    ``year`` with the per-year top song (``row_number() = 1``). Both sides
    hold one row per year; Spark picks the join strategy from their sizes."""
    totals = yearly_totals(charts, region)
    leaders = top_k_per_group(song_year_totals(charts, region, song), ["year"],
                              [F.desc("peak_streams"), *[F.asc(c) for c in song]], 1)
    j = totals.join(leaders, "year", "inner")
    return j.select("year", "total_streams", *song, "peak_streams").orderBy("year")
