"""Every raw row, kept or not, with the reason: one pass, exact counts.

A row goes for the first of these reasons, in the order of the stages: it is a
``bad record``; of another ``chart kind``; its ``date`` is none; it is of other
``years`` or another ``market``; it is ``incomplete``; its rank or streams are
``out of range``. Rows out of scope (kind, years, market) are written as their
reason alone, which costs next to nothing in Parquet; the others with all their
text, so a defect can be looked at and mended.

The pass has no shuffle of its own. Counts are taken from the written files, of
which a task that runs twice leaves one set, so reasons and kept rows add up to
the raw rows whatever was lost on the way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwise.functions.casts import parse_once, to_int_lenient, to_long_lenient
from chartwise.functions.markets import market_key, markets_frame, small
from chartwise.operators.ingest import _as_date
from chartwise.schema import RAW_COLUMNS, IngestConfig
from chartwise.sources.csv import BAD_RECORD

OUT_OF_SCOPE = ("chart kind", "years", "market")
DEFECTS = ("bad record", "date", "incomplete", "out of range")
#: Rows of ingest: in scope, complete or not.
INGESTED = "(reason IS NULL OR reason IN ('incomplete', 'out of range'))"


def judged(raw: DataFrame, cfg: IngestConfig) -> DataFrame:
    """``raw`` with ``country_code``, ``month_str`` and ``reason`` (NULL: kept)."""
    rows = parse_once(raw, _day=_as_date(raw), _rank=to_int_lenient("rank"), _streams=to_long_lenient("streams"))
    known = markets_frame(raw.sparkSession, cfg.markets).select("market_key", F.col("code").alias("country_code"))
    rows = rows.join(small(known, cfg.markets), market_key("region") == F.col("market_key"), "left").drop("market_key")
    no = lambda ok: ~F.coalesce(ok, F.lit(False))
    day, rank, streams = F.col("_day"), F.col("_rank"), F.col("_streams")
    bad = F.col(BAD_RECORD).isNotNull() if BAD_RECORD in raw.columns else F.lit(False)
    reason = F.when(bad, F.lit("bad record")).when(no(F.col("chart") == F.lit(cfg.chart)), F.lit("chart kind")) \
        .when(day.isNull(), F.lit("date")).when(no(F.year(day).between(cfg.year_from, cfg.year_to)), F.lit("years")) \
        .when(F.col("country_code").isNull(), F.lit("market")) \
        .when(F.col("title").isNull() | F.col("artist").isNull() | streams.isNull() | rank.isNull(), F.lit("incomplete")) \
        .when(no((streams > 0) & rank.between(1, cfg.max_rank)), F.lit("out of range"))
    return rows.withColumns({"month_str": F.date_format("_day", "yyyy-MM"), "reason": reason}).drop("_day", "_rank", "_streams")


def write_sifted(raw: DataFrame, cfg: IngestConfig, path: str) -> None:
    """Write all rows of ``raw`` with their reasons (see the module's text)."""
    rows = judged(raw, cfg)
    scope = F.coalesce(F.col("reason").isin(*OUT_OF_SCOPE), F.lit(False))
    columns = [*RAW_COLUMNS, "country_code", "month_str"]
    record = F.col(BAD_RECORD) if BAD_RECORD in raw.columns else F.lit(None).cast("string")
    rows.select(*[F.when(~scope, F.col(c)).alias(c) for c in columns], "reason", record.alias("record")).write.mode("overwrite").parquet(path)


def read_sifted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ingested(sifted: DataFrame) -> DataFrame:
    """What ``ingest`` gives: raw rows in scope, with market code and month."""
    return sifted.filter(INGESTED).drop("reason", "record")


def kept(sifted: DataFrame) -> DataFrame:
    return sifted.filter("reason IS NULL").drop("reason", "record", "country_code", "month_str")


def defects(sifted: DataFrame) -> DataFrame:
    """Rows that are in scope, as far as can be told, and of no use."""
    return sifted.filter(F.col("reason").isin(*DEFECTS))


def reason_counts(sifted: DataFrame) -> DataFrame:
    """(reason, rows), kept rows as ``kept``."""
    return sifted.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def funnel_of(counts: dict[str, int]) -> dict[str, int]:
    """The rows that each stage leaves, from the counts of all reasons."""
    n = lambda *reasons: sum(counts.get(r, 0) for r in reasons)
    raw = sum(counts.values())
    return {"raw_rows": raw, "bad_records": n("bad record"), "chart_rows": raw - n("bad record", "chart kind"),
            "ingested_rows": n("kept", "incomplete", "out of range"), "complete_rows": n("kept", "out of range"), "clean_rows": n("kept")}
