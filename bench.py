"""Benchmark: the chart pipeline at one scale factor, stage by stage.

Input: raw chart CSV derived once from the test tables (the pipeline's real
input format; its preparation is timed separately and not counted in the
headline). Stages: ingest + split write, clean + Parquet + table, the three
answers (each computed and written as a result file), the chart series
(built from the result files read back), the one-pass funnel, then the whole run again
end to end through ``run_job``, with and without the split-file hand-off.
The headline ``value`` is the sum of the individual stages.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chartwise.operators.clean import clean, funnel  # noqa: E402
from chartwise.operators.ingest import ingest  # noqa: E402
from chartwise.plans.runner import run_job  # noqa: E402
from chartwise.plans.questions import chart_longevity, cross_market_hits, yearly_leader  # noqa: E402
from chartwise.plans.series import series_cross_market, series_longevity, series_yearly  # noqa: E402
from chartwise.session import build_session, scratch_path  # noqa: E402
from chartwise.sources.catalog import register_table, write_charts  # noqa: E402
from chartwise.sources.csv import read_raw_csv, read_split_csv, write_raw_csv, write_split_csv  # noqa: E402
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG  # noqa: E402
from chartwise.sources.fixtures import raw_charts  # noqa: E402
from chartwise.schema import Q1_SCHEMA, Q2_SCHEMA, Q3_SCHEMA  # noqa: E402
from chartwise.sources.results import read_result_tsv, write_result_tsv  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sf = sf_dir.rsplit("sf", 1)[-1]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-wh-", dir="/tmp")}
    if not os.environ.get("SPARK_CHECKPOINT_DIR_SET"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="bench-ckpt-", dir="/tmp")
    spark = build_session(f"local[{cpus}]", "chartwise-bench", shuffle_partitions=2 * cpus, extra=extra, small_input=True)

    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        # Untimed pass over the smallest tables through the same code paths,
        # so JIT compilation and class loading are not billed to stage one.
        warm_csv = scratch_path(spark, "warm-raw")
        write_raw_csv(raw_charts(spark, warm), warm_csv)
        stages(spark, warm_csv, {})

    raw_csv = scratch_path(spark, "bench-raw")
    prep = time.perf_counter()
    write_raw_csv(raw_charts(spark, sf_dir), raw_csv)
    prepare_s = round(time.perf_counter() - prep, 3)

    times: dict[str, float] = {}
    raw_rows = stages(spark, raw_csv, times)
    stage_total = sum(v for k, v in times.items() if not k.endswith("end_to_end"))
    throughput = {f"{k}_raw_rows_per_s": round(raw_rows / v) for k, v in times.items()
                  if k.endswith("end_to_end") and v > 0}
    print(json.dumps({
        "metric": "chart_job_seconds",
        "value": round(stage_total, 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "prepare_raw_csv_s": prepare_s,
        "warmup": bool(warm and os.path.isdir(warm)),
        "raw_rows": raw_rows,
        **throughput,
    }))
    spark.stop()


def stages(spark, raw_csv: str, times: dict) -> int:
    """Run and time every stage; returns the number of raw rows."""
    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    work = scratch_path(spark, "bench-run")
    split_dir, clean_dir = f"{work}/split", f"{work}/clean"
    timed("ingest_split", lambda: write_split_csv(ingest(read_raw_csv(spark, raw_csv), CFG), split_dir))
    counts = timed("funnel", lambda: funnel(read_raw_csv(spark, raw_csv), CFG).first())
    timed("clean_write", lambda: write_charts(
        clean(read_split_csv(spark, split_dir).drop("country_code", "month_str"), CFG.markets), clean_dir))
    db = "bench_" + work.rsplit("-", 1)[-1]
    charts = timed("register_table", lambda: register_table(spark, clean_dir, db, "charts"))
    answers = {"q1_cross_market": (cross_market_hits(charts, known_markets=[m.code for m in CFG.markets]), Q1_SCHEMA),
               "q2_longevity": (chart_longevity(charts, known_years=(CFG.year_from, CFG.year_to)), Q2_SCHEMA),
               "q3_yearly_leader": (yearly_leader(charts, CFG.leader_region), Q3_SCHEMA)}
    result_dirs = {}
    for name, (df, _) in answers.items():  # compute each answer and write its result file
        result_dirs[name] = f"{work}/results/{name}"
        timed(name, lambda df=df, name=name: write_result_tsv(df, result_dirs[name], single_file=True))

    def series_from_files():
        q1, q2, q3 = (read_result_tsv(spark, result_dirs[n], schema) for n, (_, schema) in answers.items())
        return [series_cross_market(q1).collect(), series_longevity(q2, CFG.markets).collect(),
                series_yearly(q3).collect()]
    timed("series", series_from_files)
    timed("run_end_to_end", lambda: run_job(spark, raw_csv, scratch_path(spark, "bench-e2e"), CFG,
                                            db=db + "_e2e", split_files=True))
    timed("run_fused_end_to_end", lambda: run_job(spark, raw_csv, scratch_path(spark, "bench-fused"), CFG,
                                                  db=db + "_fused", split_files=False))
    return int(counts.raw_rows)


if __name__ == "__main__":
    main()
