"""End-to-end run: raw CSV -> sifted rows -> clean Parquet -> catalog table ->
three answers -> result files -> gates -> chart series (as files, too).

Each stage writes to the shared folder and the next one reads that, so lineage
is cut at every stage (a lost executor re-runs one stage, not the whole
chain). Stages hand over Parquet; the split CSV files per market and month
are an export for other tools. What makes a stage skippable on a re-run is in
``plans.stages``. Small independent stages (the answers, the series) run side
by side.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwise.operators import sift
from chartwise.operators.clean import clean
from chartwise.operators.quality import GateError
from chartwise.plans.questions import chart_longevity, cross_market_hits, yearly_leader
from chartwise.plans.series import series_cross_market, series_longevity, series_yearly
from chartwise.plans.stages import Stages, fingerprint, input_listing
from chartwise.schema import Q1_SCHEMA, Q2_SCHEMA, Q3_SCHEMA, IngestConfig
from chartwise.sources.catalog import read_charts, register_table, write_charts
from chartwise.sources.csv import BAD_RECORD, is_good, read_raw_csv, write_split_csv
from chartwise.sources.results import read_result_tsv, result_facts, write_result_tsv

#: Rows of a (market, year) beyond which several tasks write it.
CUT_ROWS = 2_000_000

RESULT_SCHEMAS = {"q1": Q1_SCHEMA, "q2": Q2_SCHEMA, "q3": Q3_SCHEMA}


@dataclass
class RunResult:
    """``metrics`` are counts of written files. ``rejects`` are the raw rows
    in scope that were of no use, each with its reason. ``approximate`` would
    name counts that a lost task can change: there are none."""

    charts: DataFrame
    answers: dict[str, DataFrame]
    reloaded: dict[str, DataFrame]
    series: dict[str, DataFrame]
    rejects: DataFrame
    metrics: dict[str, int] = field(default_factory=dict)
    approximate: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)


def answers_of(charts: DataFrame, cfg: IngestConfig, min_markets: int = 3, k_hits: int = 30, k_longevity: int = 5) -> dict[str, DataFrame]:
    """The three answers. Q1 and Q2 have shorter ways if no other markets and
    years than those of ``cfg`` are there; charts partitioned by market and year
    show that by their folders, without a look into files."""
    codes, years = [m.code for m in cfg.markets], (cfg.year_from, cfg.year_to)
    listed = charts.filter(F.col("region").isNotNull() & ~F.col("region").isin(codes)).isEmpty()
    dated = charts.filter(~F.coalesce(F.col("year").between(*years), F.lit(False))).isEmpty()
    return {
        "q1": cross_market_hits(charts, min_markets, k_hits, known_markets=codes if listed else None),
        "q2": chart_longevity(charts, k_longevity, known_years=years if dated else None),
        "q3": yearly_leader(charts, cfg.leader_region),
    }


def series_of(results: dict[str, DataFrame], cfg: IngestConfig, k_longevity: int = 5) -> dict[str, DataFrame]:
    return {
        "cross_market": series_cross_market(results["q1"]),
        "longevity": series_longevity(results["q2"], cfg.markets, k_longevity),
        "yearly": series_yearly(results["q3"]),
    }


def good_records(raw: DataFrame) -> DataFrame:
    """Raw rows without the bad records, if these are marked."""
    if BAD_RECORD not in raw.columns:
        return raw
    return raw.filter(is_good(next(c for c in raw.columns if c != BAD_RECORD))).drop(BAD_RECORD)


def _side_by_side(spark: SparkSession, tasks: dict[str, Callable]) -> dict:
    """Run independent Spark jobs at once; the first error is raised."""
    if not tasks:
        return {}
    with ThreadPoolExecutor(len(tasks)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(f)) for name, f in tasks.items()}
        return {name: r.result() for name, r in running.items()}


def run_job(spark: SparkSession, raw, workdir: str, cfg: IngestConfig,
            db: str = "charts_db", table: str = "charts", min_markets: int = 3,
            k_hits: int = 30, k_longevity: int = 5, split_files: bool = False,
            multi_line: bool = True, bad_records: str = "drop") -> RunResult:
    """``raw`` is a CSV path (file, folder or glob pattern) or a DataFrame of
    raw text rows. Stops at the first failed gate.

    The raw rows are read once and written with what becomes of each
    (``operators.sift``); all counts come from there. ``split_files=True`` also
    exports the rows in scope as CSV files per (market, month). Quoted fields
    may hold line breaks unless ``multi_line`` is off. Bad records are left out
    and counted, or with ``bad_records="fail"`` end the run.

    Clean charts go to a folder of their own for each run that writes any, and
    the table moves there when they are complete: what a killed run leaves
    behind harms nothing, and the last finished version stays readable."""
    base = workdir.rstrip("/")
    sifted_dir, split_dir = f"{base}/sifted", f"{base}/split"
    stages = Stages(spark, base)
    if bad_records not in ("drop", "fail"):
        raise ValueError("bad_records must be drop or fail")

    # a DataFrame has no listing to compare: its first stage always runs
    given = input_listing(spark, raw) if isinstance(raw, str) else uuid.uuid4().hex
    mark_in = fingerprint(chart=cfg.chart, years=(cfg.year_from, cfg.year_to), markets=cfg.markets, max_rank=cfg.max_rank,
                          multi_line=multi_line, bad=bad_records, split=split_files, given=given)

    # 1. ingest: every raw row with its reason
    if not stages.done("ingest", split_dir if split_files else sifted_dir, mark_in):
        stages.starting("ingest")
        rows = raw
        if isinstance(raw, str):
            rows = read_raw_csv(spark, raw, multi_line=multi_line, bad_records="keep" if bad_records == "drop" else "fail")
        sift.write_sifted(rows, cfg, sifted_dir)
        sifted = sift.read_sifted(spark, sifted_dir)
        counts = {r.reason: r.rows for r in sift.reason_counts(sifted).collect()}  # a row per reason
        if not sift.funnel_of(counts)["ingested_rows"]:
            raise GateError("ingest: no rows matched chart kind, years and markets")
        if split_files:
            write_split_csv(sift.ingested(sifted), split_dir)
        stages.finished("ingest", mark_in, counts)
    sifted = sift.read_sifted(spark, sifted_dir)
    counts = stages.counts("ingest")
    metrics = sift.funnel_of(counts) | {f"rejected: {r}": counts.get(r, 0) for r in (*sift.DEFECTS, *sift.OUT_OF_SCOPE)}

    # 2. clean -> Parquet, in a folder of its own
    mark_clean = fingerprint(before=mark_in, max_rank=cfg.max_rank)
    clean_dir = stages.output("clean") or ""
    if not stages.done("clean", clean_dir, mark_clean):
        if not metrics["clean_rows"]:
            raise GateError("clean: no row was complete and in range")
        before, clean_dir = clean_dir, f"{base}/clean/{uuid.uuid4().hex[:12]}"
        # only where there are rows enough for a hot folder
        write_charts(clean(sift.kept(sifted), cfg.markets, cfg.max_rank), clean_dir, cut_rows=CUT_ROWS if metrics["clean_rows"] > CUT_ROWS else None)
        written = read_charts(spark, clean_dir).count()
        if written != metrics["clean_rows"]:
            raise GateError(f"clean: {written} rows were written of {metrics['clean_rows']}")
        stages.finished("clean", mark_clean, output=clean_dir)
    else:
        before = clean_dir

    # 3. table (fails when empty); then the version before the last can go
    charts = register_table(spark, clean_dir, db, table)
    if before and before != clean_dir:
        stages.keep_versions("clean", f"{base}/clean", (before, clean_dir))

    # 4. answers -> result files (each answer is bounded: top-k or per year)
    answers = answers_of(charts, cfg, min_markets, k_hits, k_longevity)
    settings = {"q1": (min_markets, k_hits), "q2": (k_longevity,), "q3": (cfg.leader_region,)}
    marks = {n: fingerprint(before=mark_clean, question=n, settings=settings[n]) for n in answers}
    paths = {n: f"{base}/results/{n}" for n in answers}
    fresh = [n for n in answers if not stages.done(n, paths[n], marks[n])]
    for n in fresh:
        stages.starting(n)
    made = _side_by_side(spark, {n: lambda n=n: write_result_tsv(answers[n], paths[n], single_file=True) for n in fresh})
    reloaded = {n: read_result_tsv(spark, paths[n], RESULT_SCHEMAS[n]) for n in answers}

    # 5. gate the result files as read back: rows, and the very rows that were written
    found = {r.result: (r.rows, r.checksum) for r in result_facts(reloaded).collect()}  # a row per result
    for n in answers:
        rows, checksum = found[n]
        if not rows:
            raise GateError(f"{n}: query returned 0 rows")
        known = made[n] if n in made else stages.counts(n)
        if (rows, checksum) != (known["rows"], known["checksum"]):
            raise GateError(f"{n}: the result file holds {rows} rows, {known['rows']} were written, or other ones")
        metrics[f"{n}_rows"] = rows
    for n in fresh:
        stages.finished(n, marks[n], made[n])

    # 6. chart series from the result files
    series, todo = {}, {}
    for name, df in series_of(reloaded, cfg, k_longevity).items():
        path, mark = f"{base}/series/{name}", fingerprint(before=marks, series=name, markets=cfg.markets)
        if not stages.done(f"series_{name}", path, mark):
            stages.starting(f"series_{name}")
            todo[name] = (df, path, mark)
        series[name] = (path, df.schema)
    for name, facts in _side_by_side(spark, {n: lambda d=df, p=path: write_result_tsv(d, p, single_file=True) for n, (df, path, _) in todo.items()}).items():
        stages.finished(f"series_{name}", todo[name][2], facts)
    return RunResult(charts=charts, answers=answers, reloaded=reloaded, series={n: read_result_tsv(spark, p, s) for n, (p, s) in series.items()},
                     rejects=sift.defects(sifted), metrics=metrics, skipped=stages.skipped)


def market_counts(charts: DataFrame) -> list[tuple[str, int]]:
    """Rows of each market, most first: a few rows, for display."""
    return [(r.region, r.rows) for r in charts.groupBy("region").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "region").limit(1000).collect()]
