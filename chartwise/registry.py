"""Every operator as a named query over the driver's test tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame; the raw rows
come from ``sources.fixtures.raw_charts``. Keys that exercise a writer write
to a fresh folder under the shared folder (``spark.checkpoint.dir``) and
return what reading it back gives.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwise.functions.casts import coerce_numeric, to_chart_date, to_int_lenient, to_long_lenient
from chartwise.functions.markets import display_name, market_code
from chartwise.functions.text import ascii_safe, label
from chartwise.operators import clean as C
from chartwise.operators import ingest as I
from chartwise.operators import sift
from chartwise.operators import summaries as U
from chartwise.operators.quality import quality_report
from chartwise.plans import questions as Q
from chartwise.plans import series as S
from chartwise.plans import summary
from chartwise.plans.runner import answers_of, run_job
from chartwise.schema import Q1_SCHEMA, Q2_SCHEMA, Q3_SCHEMA, RAW_COLUMNS
from chartwise.session import scratch_path
from chartwise.sources import catalog, csv, results
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG
from chartwise.sources.fixtures import raw_charts, table
from chartwise.streaming.incremental import run_clean_stream, run_ingest_clean_streams
from chartwise.streaming.segments import clean_charts, run_segment_stream

# Series parameters sized for fixture totals (thousands of streams per year)
# so that both sides of the bar-height rule are exercised.
FIXTURE_SCALE = 1e4
FIXTURE_MIN_BAR = 0.45

# Rows of a landing file of the segment stream, about.
LANDING_ROWS = 250_000

MESSY_NAMES = ("  Date", "REGION ", "Chart", "Trend", "Rank", "Title", "Artist", "Streams", "Track URL")


def _raw(spark, sf):
    return raw_charts(spark, sf)


def _ingested(spark, sf):
    return I.ingest(_raw(spark, sf), CFG)


def _charts(spark, sf):
    raw_kept = _ingested(spark, sf).drop("country_code", "month_str")
    return C.clean(raw_kept, CFG.markets, CFG.max_rank)


def _typed(spark, sf):
    return C.cast_types(C.normalize_region(_raw(spark, sf), CFG.markets))


def _q1(spark, sf):
    return Q.cross_market_hits(_charts(spark, sf), 3, 30, known_markets=[m.code for m in CFG.markets])


def _q2(spark, sf):
    return Q.chart_longevity(_charts(spark, sf), 5)


def _q2_days(spark, sf):
    return Q.chart_longevity(_charts(spark, sf), 5, known_years=(CFG.year_from, CFG.year_to))


def _q3(spark, sf):
    return Q.yearly_leader(_charts(spark, sf), CFG.leader_region)


# --- sources / sinks -------------------------------------------------------

def scan_raw_csv(spark, sf):
    path = scratch_path(spark, "raw-csv")
    csv.write_raw_csv(_raw(spark, sf), path)
    return csv.read_raw_csv(spark, path)


def scan_raw_csv_messy(spark, sf):
    """Titles with line breaks, quotes and commas: whole document texts."""
    c = F.col
    rows = table(spark, sf, "documents").select(
        F.lit("1998-01-01").alias("date"), F.lit("nation_2").alias("region"), F.lit("top200").alias("chart"),
        F.lit(None).cast("string").alias("trend"), F.lit("1").alias("rank"), c("text").alias("title"),
        F.concat("source", F.lit(', "'), "lang", F.lit('"')).alias("artist"), c("n_chars").cast("string").alias("streams"),
        F.concat(F.lit("x,\n"), c("doc_id").cast("string")).alias("url"))
    path = scratch_path(spark, "raw-messy")
    csv.write_raw_csv(rows, path)
    return csv.read_raw_csv(spark, path, multi_line=True)


def bad_csv_records(spark, sf):
    """One line a document, two in seven with too few or too many fields."""
    d = F.col("doc_id")
    line = F.concat(F.lit("1998-01-01,nation_2,top200,,1,t,a,5"),
                    F.when(d % 7 == 1, F.lit("")).when(d % 7 == 2, F.lit(",u,one more")).otherwise(F.lit(",u")))
    path = scratch_path(spark, "raw-bad")
    lines = table(spark, sf, "documents").select(line.alias("value"))
    lines.write.text(path)
    raw = csv.read_raw_csv(spark, path, by_name=False, bad_records="keep", header="false")
    return raw.agg(F.count("*").alias("raw_rows"), F.count(csv.BAD_RECORD).alias("bad_records"),
                   F.count_if(csv.is_good("date")).alias("good_rows"))


def misframed_csv(spark, sf):
    """One record a document, in files of 500 each behind a header: fields
    too few, a quote in the last column that is never closed (the record after
    it breaks its own last column over two lines), literal quotes. Bad records
    come as text."""
    d, text = F.col("doc_id"), lambda c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
    head = F.concat(F.lit("1998-01-01,nation_2,top200,,1,"), text("text"))
    line = F.when(d % 7 == 1, F.lit("1998-01-01,nation_2")) \
        .when(d % 7 == 3, F.concat(F.lit('1998-01-01,nation_2,top200,,1,t,a,5,"http'), d)) \
        .when(d % 7 == 4, F.concat(head, F.lit(',"a ""b"", c",5,"http\n'), d, F.lit('"'))) \
        .when(d % 7 == 5, F.concat(head, F.lit(',12" mix,5,'), d)).otherwise(F.concat(head, F.lit(",a,5,"), d))
    rows = table(spark, sf, "documents").select("doc_id", line.alias("line")).groupBy(F.floor(d / 500)) \
        .agg(F.array_sort(F.collect_list(F.struct("doc_id", "line"))).alias("x"))
    path = scratch_path(spark, "raw-misframed")
    rows.select(F.concat_ws("\n", F.lit(",".join(RAW_COLUMNS)), F.array_join(F.transform("x", lambda x: x["line"]), "\n")).alias("value")).write.text(path)
    raw = csv.read_raw_csv(spark, path, bad_records="keep")
    good = F.col(csv.BAD_RECORD).isNull()
    return raw.select(*[F.when(good, F.col(c)).alias(c) for c in ("title", "artist", "url")], F.col(csv.BAD_RECORD).alias("bad"))


def rerun_changed_params(spark, sf):
    """A second run in the same folder with another k: the fresh answer."""
    raw_csv, work = scratch_path(spark, "rerun-raw"), scratch_path(spark, "rerun")
    csv.write_raw_csv(_raw(spark, sf), raw_csv)
    db = "chartwise_run_" + work.rsplit("-", 1)[-1]
    run_job(spark, raw_csv, work, CFG, db=db, k_longevity=2)
    res = run_job(spark, raw_csv, work, CFG, db=db, k_longevity=5)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return res.reloaded["q2"]


def split_counts(spark, sf):
    path = scratch_path(spark, "split")
    csv.write_split_csv(_ingested(spark, sf), path)
    back = csv.read_split_csv(spark, path)
    return back.groupBy("country_code", "month_str").agg(F.count(F.lit(1)).alias("rows"))


def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "charts-parquet")
    catalog.write_charts(_charts(spark, sf), path)
    return catalog.read_charts(spark, path)


def table_roundtrip(spark, sf):
    path = scratch_path(spark, "charts-table")
    catalog.write_charts(_charts(spark, sf), path)
    name = "charts_" + path.rsplit("-", 1)[-1]
    return catalog.register_table(spark, path, "chartwise_check", name)


def result_roundtrip(spark, sf):
    """Q1 with some titles empty and some artists NULL, both read back NULL."""
    path = scratch_path(spark, "q1-tsv")
    n = F.col("total_appearances")
    q1 = _q1(spark, sf).withColumns({"title": F.when(n % 5 == 0, F.lit("")).otherwise(F.col("title")),
                                     "artist": F.when(n % 3 != 0, F.col("artist"))})
    results.write_result_tsv(q1, path, single_file=True)
    return results.read_result_tsv(spark, path, Q1_SCHEMA)


def noise_lines(spark, sf):
    """Document lines as a console-style result file of three columns, among
    lines that each rule of the reader alone must keep out: one behind every
    noise prefix, a repeated header, a line without a tab (all with a valid
    number), one with a field too many, one with no number; and one with a
    field too few, which stays."""
    docs = table(spark, sf, "documents")
    i, tab = F.col("doc_id").cast("string"), F.lit("\t")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    kinds = [lines.select(F.concat(i, tab, "line", tab, F.length("line").cast("string")).alias("value"))]
    for other in [*[F.concat(F.lit(f"{p}seen"), tab, F.lit("x"), tab, i) for p in results.NOISE_PREFIXES],
                  F.concat(F.lit("doc_id"), tab, F.lit("line"), tab, i), i, F.concat(i, tab, F.lit("short")),
                  F.concat(i, tab, F.lit("a"), tab, F.lit("1"), tab, F.lit("b")),
                  F.concat(F.lit("none"), tab, F.lit("of "), i, tab, F.lit("12d"))]:
        kinds.append(docs.select(other.alias("value")))
    path = scratch_path(spark, "noisy-lines")
    reduce(lambda a, b: a.unionAll(b), kinds).write.text(path)
    return results.read_noisy_lines(spark, path, ["doc_id", "line", "width"], numeric=["doc_id", "width"])


def stream_clean(spark, sf):
    split = scratch_path(spark, "stream-in")
    out = scratch_path(spark, "stream-out")
    csv.write_split_csv(_ingested(spark, sf), split)
    run_clean_stream(spark, split, out, scratch_path(spark, "stream-ckpt"), CFG)
    return catalog.read_charts(spark, out)


def end_to_end_run(spark, sf):
    """The whole run from raw CSV (ingest, split write, clean, Parquet, table,
    answers, result files, gates); returns the longevity answer as read back
    from its result file."""
    raw_csv = scratch_path(spark, "run-raw")
    csv.write_raw_csv(_raw(spark, sf), raw_csv)
    work = scratch_path(spark, "run")
    db = "chartwise_run_" + work.rsplit("-", 1)[-1]
    res = run_job(spark, raw_csv, work, CFG, db=db, split_files=True)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return res.reloaded["q2"]


def stream_ingest_clean(spark, sf):
    """Raw CSV landing folder -> ingest stream (split CSV sink) -> clean
    stream (Parquet sink); returns the Parquet output read back."""
    landing = scratch_path(spark, "stream-raw")
    csv.write_raw_csv(_raw(spark, sf), landing)
    split, out = scratch_path(spark, "stream-split"), scratch_path(spark, "stream-charts")
    run_ingest_clean_streams(spark, landing, split, out, scratch_path(spark, "stream-ckpts"), CFG)
    return catalog.read_charts(spark, out)


def _segments(spark, sf):
    """Raw CSV in eight files, or more with more rows, each written by a task of
    bounded size; taken in by four batches or five."""
    landing = scratch_path(spark, "segment-raw")
    files = max(8, -(-table(spark, sf, "lineitem").count() // LANDING_ROWS))
    csv.write_raw_csv(_raw(spark, sf).repartition(files, *RAW_COLUMNS), landing)  # by whole rows: no value fills one task
    return run_segment_stream(spark, landing, scratch_path(spark, "segments"), scratch_path(spark, "segment-ckpt"), CFG, max_files_per_batch=files // 4, fan=2)


def stream_segments(spark, sf):
    return clean_charts(_segments(spark, sf), CFG)


def stream_ledger(spark, sf):
    """The ledger of a stream's batches as rows: a bounded few."""
    return spark.createDataFrame(sorted(_segments(spark, sf).counts().items()), "reason string, rows long")


def quality_gates(spark, sf):
    """Gates over one materialised run: the ingest output and the clean table
    are written once to the shared folder; the three answers are computed
    from that table, written as result files and read back for the gates."""
    split_dir, clean_dir = scratch_path(spark, "gate-split"), scratch_path(spark, "gate-clean")
    csv.write_split_csv(_ingested(spark, sf), split_dir)
    ingested = csv.read_split_csv(spark, split_dir)
    catalog.write_charts(C.clean(ingested.drop("country_code", "month_str"), CFG.markets, CFG.max_rank), clean_dir)
    charts = catalog.read_charts(spark, clean_dir)
    reloaded = {}
    for name, df, schema in (("q1", Q.cross_market_hits(charts, 3, 30), Q1_SCHEMA),
                             ("q2", Q.chart_longevity(charts, 5), Q2_SCHEMA),
                             ("q3", Q.yearly_leader(charts, CFG.leader_region), Q3_SCHEMA)):
        path = scratch_path(spark, f"gate-{name}")
        results.write_result_tsv(df, path, single_file=True)
        reloaded[f"result_{name}"] = results.read_result_tsv(spark, path, schema)
    return quality_report({"ingest": ingested, "table": charts, **reloaded})


def reject_reasons(spark, sf):
    """Rows of each reason in the files of a sifted run, with bad records and
    empty regions among them."""
    raw = _raw(spark, sf)
    bad = F.when(F.col("artist").endswith("1") & F.col("rank").endswith("3"), F.lit("x,y"))
    raw = raw.withColumn("region", F.when(F.col("rank").endswith("4"), F.lit("")).otherwise(F.col("region"))).withColumn(csv.BAD_RECORD, bad)
    path = scratch_path(spark, "sifted")
    sift.write_sifted(raw, CFG, path)
    return sift.reason_counts(sift.read_sifted(spark, path))


def defect_rows(spark, sf):
    """Rows in scope and of no use, with all their text."""
    path = scratch_path(spark, "sifted")
    sift.write_sifted(_raw(spark, sf), CFG, path)
    return sift.defects(sift.read_sifted(spark, path)).select("reason", *RAW_COLUMNS, "country_code", "month_str")


def empty_region(spark, sf):
    """Regions blanked out are no regions: their rows are incomplete, and what
    is written reads back the same."""
    raw = _raw(spark, sf)
    raw = raw.withColumn("region", F.when(F.col("rank").endswith("4"), F.lit("")).otherwise(F.col("region")))
    path = scratch_path(spark, "charts-empty-region")
    catalog.write_charts(C.clean(raw, CFG.markets, CFG.max_rank), path)
    return catalog.read_charts(spark, path)


def q1_unlisted_markets(spark, sf):
    """Q1 as a run asks it, over charts with regions that no market names."""
    return answers_of(C.clean(_raw(spark, sf), CFG.markets, CFG.max_rank), CFG)["q1"]


def _kept_up(spark, sf):
    """Partials made from the rows of odd days, then brought up to date for
    the months that the other rows, of even months alone, are in; odd months
    keep what they had, so their even days never come."""
    charts = _charts(spark, sf)
    even_month, even_day = F.month("date") % 2 == 0, F.dayofmonth("date") % 2 == 0
    at, first = scratch_path(spark, "charts-growing"), charts.filter(~even_day)
    catalog.write_charts(first, at)
    path = scratch_path(spark, "summary")
    summary.update(catalog.read_charts(spark, at), path)
    new = charts.filter(even_day & even_month)
    catalog.write_charts(new, at, mode="append")
    summary.update(catalog.read_charts(spark, at), path, summary.months_in(new))
    return summary.read_summary(spark, path)


def parquet_codec(spark, sf):
    """Codec and rows of the written column chunks, from the files' footers."""
    path = scratch_path(spark, "charts-codec")
    catalog.write_charts(_charts(spark, sf), path)
    return catalog.read_codecs(spark, path).groupBy("codec").agg(F.sum("rows").cast("bigint").alias("rows"))


# --- projections, filters, lookups, scalar functions ---------------------

def normalize_columns(spark, sf):
    return C.normalize_columns(_raw(spark, sf).toDF(*MESSY_NAMES))


def preview(spark, sf):
    return U.preview(_charts(spark, sf), ["date", "region", "rank", "title", "artist", "streams"], 5)


def region_normalize(spark, sf):
    return _raw(spark, sf).select(F.col("region").alias("raw_region"),
                                  market_code("region", CFG.markets).alias("region"))


def type_cast(spark, sf):
    rank, streams = F.col("rank"), F.col("streams")
    r = _raw(spark, sf).withColumn("streams", F.when(rank.endswith("7"), F.concat(streams, F.lit("d")))
                                   .when(rank.endswith("8"), F.lit("9007199254740993.0"))
                                   .when(rank.endswith("9"), F.lit("0x1p3")).otherwise(streams))
    d = to_chart_date("date")
    return r.select(F.col("date").alias("raw_date"), F.col("rank").alias("raw_rank"),
                    F.col("streams").alias("raw_streams"), d.alias("date"),
                    to_int_lenient("rank").alias("rank"), to_long_lenient("streams").alias("streams"),
                    F.year(d).alias("year"))


def month_bucket(spark, sf):
    return I.with_month_bucket(_raw(spark, sf).select("date"))


def lookup_market(spark, sf):
    return I.lookup_market(_raw(spark, sf), CFG.markets)


def lookup_display(spark, sf):
    everything = C.clean(_raw(spark, sf), CFG.markets, CFG.max_rank)  # no ingest: unknown regions stay
    counts = everything.groupBy("region").agg(F.count(F.lit(1)).alias("rows"))
    return counts.select("region", display_name("region", CFG.markets).alias("display"), "rows")


def union_sources(spark, sf):
    raw = _raw(spark, sf)
    half = F.pmod(F.crc32("url"), F.lit(2)) == 0
    first, second = raw.filter(half), raw.filter(~half).select(*reversed(RAW_COLUMNS))
    return I.ingest(first, CFG).unionByName(I.ingest(second, CFG))


def coerce_numeric_q(spark, sf):
    """Numbers among text that is none, such as ``n/a``, ``x15`` and ``20f``."""
    rank, streams = F.col("rank"), F.col("streams")
    odd = {"rank": F.when(rank.endswith("5"), F.concat(F.lit("x"), rank)).otherwise(rank),
           "streams": F.when(streams.isNull(), F.lit("n/a")).when(rank.endswith("0"), F.concat(streams, F.lit("f"))).otherwise(streams)}
    r = _raw(spark, sf).withColumns(odd).select("title", "artist", coerce_numeric("rank").alias("rank"),
                                                coerce_numeric("streams").alias("streams"))
    return r.dropna(how="all", subset=["rank", "streams"])


def label_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", label("text").alias("label"), ascii_safe("text").alias("ascii_text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # sources, sinks, catalog
        "scan_raw_csv": scan_raw_csv,
        "scan_raw_csv_messy": scan_raw_csv_messy,
        "bad_csv_records": bad_csv_records,
        "misframed_csv": misframed_csv,
        "rerun_changed_params": rerun_changed_params,
        "reject_reasons": reject_reasons,
        "defect_rows": defect_rows,
        "empty_region": empty_region,
        "q1_unlisted_markets": q1_unlisted_markets,
        "parquet_codec": parquet_codec,
        "summary_rows": _kept_up,
        "summary_q1": lambda s, sf: summary.cross_market_hits(_kept_up(s, sf), 3, 30),
        "summary_q2": lambda s, sf: summary.chart_longevity(_kept_up(s, sf), 5),
        "summary_q3": lambda s, sf: summary.yearly_leader(_kept_up(s, sf), CFG.leader_region),
        "split_counts": split_counts,
        "parquet_roundtrip": parquet_roundtrip,
        "table_roundtrip": table_roundtrip,
        "result_roundtrip": result_roundtrip,
        "noise_lines": noise_lines,
        "stream_clean": stream_clean,
        "stream_ingest_clean": stream_ingest_clean,
        "stream_segments": stream_segments,
        "stream_ledger": stream_ledger,
        # projections and scalar functions
        "normalize_columns": normalize_columns,
        "preview": preview,
        "region_normalize": region_normalize,
        "type_cast": type_cast,
        "month_bucket": month_bucket,
        "coerce_numeric": coerce_numeric_q,
        "label_text": label_text,
        # filters, joins, set ops
        "filter_chart": lambda s, sf: I.filter_chart(_raw(s, sf), CFG.chart),
        "filter_years": lambda s, sf: I.filter_years(_raw(s, sf), CFG.year_from, CFG.year_to),
        "filter_markets": lambda s, sf: I.filter_markets(_raw(s, sf), CFG.markets),
        "lookup_market": lookup_market,
        "lookup_display": lookup_display,
        "drop_incomplete": lambda s, sf: C.drop_incomplete(_typed(s, sf)),
        "filter_valid": lambda s, sf: C.filter_valid(C.drop_incomplete(_typed(s, sf)), CFG.max_rank),
        "union_sources": union_sources,
        # jobs
        "ingest_charts": _ingested,
        "clean_charts": _charts,
        "clean_funnel": lambda s, sf: C.funnel(_raw(s, sf), CFG),
        "count_by_region": lambda s, sf: U.count_by(_charts(s, sf), "region"),
        "distinct_markets": lambda s, sf: U.distinct_values(_charts(s, sf), "region"),
        "song_year_totals": lambda s, sf: Q.song_year_totals(_charts(s, sf), CFG.leader_region),
        "yearly_totals": lambda s, sf: Q.yearly_totals(_charts(s, sf), CFG.leader_region),
        "q1_cross_market": _q1,
        "q2_longevity": _q2,
        "q2_day_sets": _q2_days,
        "q3_yearly_leader": _q3,
        "q3_yearly_leader_join": lambda s, sf: Q.yearly_leader_join(_charts(s, sf), CFG.leader_region),
        "q1_open_markets": lambda s, sf: Q.cross_market_hits(_charts(s, sf), 3, 30),
        # results with gaps, as a reader of files may meet them
        "series_cross_market": lambda s, sf: S.series_cross_market(
            _q1(s, sf).withColumn("total_appearances", F.when(F.col("total_appearances") % 4 != 0, F.col("total_appearances")))),
        "series_longevity": lambda s, sf: S.series_longevity(
            _q2(s, sf).withColumns({"best_rank": F.when(F.col("best_rank") % 3 != 0, F.col("best_rank")),
                                    "days_on_chart": F.when(F.length("title") % 4 != 0, F.col("days_on_chart"))}), CFG.markets),
        "series_yearly": lambda s, sf: S.series_yearly(
            _q3(s, sf).withColumn("total_streams", F.when(F.col("year") != 1997, F.col("total_streams"))), FIXTURE_SCALE, FIXTURE_MIN_BAR),
        "quality_report": quality_gates,
        "end_to_end_run": end_to_end_run,
    }


__all__ = ["queries"]
