"""Command line: the whole chart pipeline, or one step of it.

    python -m chartwise run      --raw <csv> --workdir <shared folder> [--split-files]
    python -m chartwise ingest   --raw <csv> --out <folder of split CSV>
    python -m chartwise clean    --split <folder of split CSV> --out <Parquet folder>
    python -m chartwise register --charts <Parquet folder> [--db charts_db] [--table charts]
    python -m chartwise ask      --charts <Parquet folder> --out <results folder>
    python -m chartwise series   --results <results folder> --out <series folder>

Each step reads what the one before wrote. Common options: [--chart top200]
[--years 2017 2021] [--leader JP] [--markets "japan:JP:Japan,taiwan:TW:Taiwan"]
[--master local[*]]; for raw CSV [--single-line] [--strict].

Defaults are five markets, top200, 2017-2021, yearly leader for JP. Prints the
counts as one JSON line, then the rows of bounded results. On a cluster, leave
--master unset (spark-submit decides) and keep folders on shared storage.
"""

from __future__ import annotations

import argparse
import json
import sys

from chartwise.operators.clean import clean, funnel
from chartwise.operators.ingest import ingest
from chartwise.operators.quality import require_rows
from chartwise.operators.summaries import preview
from chartwise.plans.runner import RESULT_SCHEMAS, answers_of, good_records, market_counts, run_job, series_of
from chartwise.schema import (REFERENCE_CHART, REFERENCE_MARKETS, REFERENCE_MAX_RANK, REFERENCE_YEARS,
                              IngestConfig, Market)
from chartwise.session import build_session
from chartwise.sources.catalog import read_charts, register_table, write_charts
from chartwise.sources.csv import read_raw_csv, read_split_csv, write_split_csv
from chartwise.sources.results import read_result_tsv, write_result_tsv

PREVIEW = ["date", "region", "rank", "title", "artist", "streams"]


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="chartwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    paths = {"run": ("raw", "workdir"), "ingest": ("raw", "out"), "clean": ("split", "out"), "register": ("charts",),
             "ask": ("charts", "out"), "series": ("results", "out")}
    for name, needed in paths.items():
        p = sub.add_parser(name)
        for what in needed:
            p.add_argument(f"--{what}", required=True)
        p.add_argument("--chart", default=REFERENCE_CHART)
        p.add_argument("--years", nargs=2, type=int, default=list(REFERENCE_YEARS))
        p.add_argument("--max-rank", type=int, default=REFERENCE_MAX_RANK)
        p.add_argument("--leader", default="JP")
        p.add_argument("--markets", default=None, help="comma-separated name:CODE:Display entries, in display order")
        p.add_argument("--min-markets", type=int, default=3)
        p.add_argument("--hits", type=int, default=30)
        p.add_argument("--longevity", type=int, default=5)
        p.add_argument("--master", default=None)
        if name in ("run", "ingest"):
            p.add_argument("--multi-line", action="store_true", default=True, help="quoted fields may hold line breaks (the default)")
            p.add_argument("--single-line", dest="multi_line", action="store_false", help="every line is a record")
            p.add_argument("--strict", action="store_true", help="a bad record ends the job (else it is counted and left out)")
        if name in ("run", "register"):
            p.add_argument("--db", default="charts_db")
            p.add_argument("--table", default="charts")
        if name == "run":
            p.add_argument("--split-files", action="store_true", help="also export CSV files per market and month")
    return ap


def _config(args) -> IngestConfig:
    markets = REFERENCE_MARKETS
    if args.markets:
        entries = [e.split(":") for e in args.markets.split(",") if e.strip()]
        markets = tuple(Market(k.strip().lower(), c.strip(), d.strip(), i + 1) for i, (k, c, d) in enumerate(entries))
    return IngestConfig(chart=args.chart, year_from=args.years[0], year_to=args.years[1], markets=markets,
                        max_rank=args.max_rank, leader_region=args.leader)


def _show_charts(charts) -> None:
    for market, n in market_counts(charts):
        print(f"{market}\t{n}")
    preview(charts, PREVIEW, 5).show(truncate=False)


def _run(spark, args, cfg) -> dict:
    res = run_job(spark, args.raw, args.workdir, cfg, db=args.db, table=args.table, min_markets=args.min_markets,
                  k_hits=args.hits, k_longevity=args.longevity, split_files=args.split_files, multi_line=args.multi_line,
                  bad_records="fail" if args.strict else "drop")
    print(json.dumps({"metrics": res.metrics, "skipped": res.skipped}))
    _show_charts(res.charts)
    for name, df in [*res.reloaded.items(), *res.series.items()]:  # bounded result sets (top-k / per year)
        print(f"--- {name}")
        df.show(truncate=False)
    return res.metrics


def _ingest(spark, args, cfg) -> dict:
    raw = read_raw_csv(spark, args.raw, multi_line=args.multi_line, bad_records="fail" if args.strict else "keep")
    counts = funnel(raw, cfg).first().asDict()
    write_split_csv(require_rows(ingest(good_records(raw), cfg), "ingest"), args.out)
    return counts


def _clean(spark, args, cfg) -> dict:
    kept = read_split_csv(spark, args.split).drop("country_code", "month_str")
    write_charts(clean(kept, cfg.markets, cfg.max_rank), args.out)
    return {"clean_rows": require_rows(read_charts(spark, args.out), "clean").count()}


def _register(spark, args, cfg) -> dict:
    charts = register_table(spark, args.charts, args.db, args.table)
    _show_charts(charts)
    return {"table_rows": charts.count()}


def _ask(spark, args, cfg) -> dict:
    counts = {}
    for name, df in answers_of(read_charts(spark, args.charts), cfg, args.min_markets, args.hits, args.longevity).items():
        write_result_tsv(df, f"{args.out}/{name}", single_file=True)
        back = require_rows(read_result_tsv(spark, f"{args.out}/{name}", RESULT_SCHEMAS[name]), name)
        counts[f"{name}_rows"] = back.count()
        back.show(truncate=False)
    return counts


def _series(spark, args, cfg) -> dict:
    results = {n: read_result_tsv(spark, f"{args.results}/{n}", s) for n, s in RESULT_SCHEMAS.items()}
    counts = {}
    for name, df in series_of(results, cfg, args.longevity).items():
        write_result_tsv(df, f"{args.out}/{name}", single_file=True)
        counts[f"{name}_rows"] = read_result_tsv(spark, f"{args.out}/{name}", df.schema).count()
    return counts


def main(argv=None, spark=None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or build_session(args.master, "chartwise", wide_shuffles=args.master is None)
    step = {"run": _run, "ingest": _ingest, "clean": _clean, "register": _register, "ask": _ask, "series": _series}[args.cmd]
    counts = step(spark, args, _config(args))
    if args.cmd != "run":
        print(json.dumps({"metrics": counts}))
    return counts


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
