"""End-to-end run over raw CSV, skip-on-rerun, and incremental streaming."""

import os
import shutil

from chartwise.operators.clean import clean
from chartwise.operators.ingest import ingest
from chartwise.plans.runner import run_job
from chartwise.plans.questions import chart_longevity, cross_market_hits, yearly_leader
from chartwise.session import scratch_path
from chartwise.sources.catalog import read_charts
from chartwise.sources.csv import write_raw_csv, write_split_csv
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG
from chartwise.sources.fixtures import raw_charts
from chartwise.streaming.incremental import run_clean_stream

SF = "/root/testdata/sf0.001"


def _sorted(rows):
    return sorted(tuple(r) for r in rows)


def test_run_matches_direct_answers_and_skips_on_rerun(spark):
    raw_csv = scratch_path(spark, "raw")
    write_raw_csv(raw_charts(spark, SF), raw_csv)
    work = scratch_path(spark, "run")
    res = run_job(spark, raw_csv, work, CFG, db="t_pipe", split_files=True)
    direct = clean(ingest(raw_charts(spark, SF), CFG).drop("country_code", "month_str"), CFG.markets)
    assert res.metrics["ingested_rows"] == 561 and res.metrics["clean_rows"] == 372
    funnel = [res.metrics[k] for k in ("raw_rows", "chart_rows", "ingested_rows", "complete_rows", "clean_rows")]
    assert funnel == [6000, 4067, 561, 458, 372]
    assert _sorted(res.reloaded["q1"].collect()) == _sorted(cross_market_hits(direct).collect())
    assert _sorted(res.reloaded["q2"].collect()) == _sorted(chart_longevity(direct).collect())
    assert _sorted(res.reloaded["q3"].collect()) == _sorted(yearly_leader(direct, "JP").collect())
    assert len(res.series["cross_market"].collect()) == 30 and len(res.series["yearly"].collect()) == 5
    again = run_job(spark, raw_csv, work, CFG, db="t_pipe", split_files=True)
    assert set(again.skipped) == {"ingest", "clean", "q1", "q2", "q3", "series_cross_market", "series_longevity", "series_yearly"}


def test_fused_run_equals_split_run(spark):
    raw_csv = scratch_path(spark, "raw")
    write_raw_csv(raw_charts(spark, SF), raw_csv)
    split = run_job(spark, raw_csv, scratch_path(spark, "a"), CFG, db="t_a", split_files=True)
    fused = run_job(spark, raw_csv, scratch_path(spark, "b"), CFG, db="t_b", split_files=False)
    assert fused.metrics["ingested_rows"] == split.metrics["ingested_rows"] == 561
    assert fused.metrics["clean_rows"] == 372 and fused.metrics["raw_rows"] == 6000 and fused.metrics["complete_rows"] == 458
    for q in ("q1", "q2", "q3"):
        assert _sorted(fused.reloaded[q].collect()) == _sorted(split.reloaded[q].collect())


def test_stream_processes_only_new_files(spark):
    ingested = ingest(raw_charts(spark, SF), CFG)
    landing = scratch_path(spark, "landing")
    stage = scratch_path(spark, "stage")
    write_split_csv(ingested, stage)
    os.makedirs(landing)
    parts = sorted(d for d in os.listdir(stage) if d.startswith("country_code="))
    first, second = parts[: len(parts) // 2], parts[len(parts) // 2:]
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    for d in first:
        shutil.copytree(os.path.join(stage, d), os.path.join(landing, d))
    run_clean_stream(spark, landing, out, ckpt, CFG)
    n1 = read_charts(spark, out).count()
    for d in second:
        shutil.copytree(os.path.join(stage, d), os.path.join(landing, d))
    run_clean_stream(spark, landing, out, ckpt, CFG)
    expected = clean(ingested.drop("country_code", "month_str"), CFG.markets)
    got = read_charts(spark, out)
    assert 0 < n1 < got.count()
    assert _sorted(got.collect()) == _sorted(expected.collect())


def test_split_counts_sum_to_ingest_count(spark):
    from __spark_entry__ import queries
    counts = queries()["split_counts"](spark, SF)
    assert counts.agg({"rows": "sum"}).first()[0] == ingest(raw_charts(spark, SF), CFG).count() == 561


def test_table_by_name_after_use(spark):
    from chartwise.sources.catalog import register_table, use_database, write_charts
    path = scratch_path(spark, "tbl")
    write_charts(clean(ingest(raw_charts(spark, SF), CFG).drop("country_code", "month_str"), CFG.markets), path)
    register_table(spark, path, "t_use", "charts")
    before = spark.catalog.currentDatabase()
    try:
        use_database(spark, "t_use")
        assert spark.sql("SELECT COUNT(*) AS n FROM charts").first().n == 372
        # dropping the external table leaves its files
        spark.sql("DROP TABLE charts")
        assert read_charts(spark, path).count() == 372
    finally:
        use_database(spark, before)


def test_command_line_run(spark, tmp_dir):
    """The CLI with the reference defaults on a handmade raw file."""
    from chartwise.__main__ import main
    raw = os.path.join(tmp_dir, "charts.csv")
    with open(raw, "w") as f:
        f.write("title,rank,date,artist,url,region,chart,trend,streams\n")  # columns in another order
        for day in range(1, 4):
            for region in ("Japan", "Taiwan", "Hong Kong", "Brazil"):
                f.write(f"Song A,1,2018-01-0{day},Artist,u,{region},top200,SAME_POSITION,1000\n")
                f.write(f"Song B,2,2018-01-0{day},Other,u,{region},top200,SAME_POSITION,500\n")
        f.write("Song C,1,2016-12-31,X,u,Japan,top200,NEW_ENTRY,10\n")  # outside the years
        f.write("Song D,1,2018-01-01,X,u,Japan,viral50,NEW_ENTRY,10\n")  # other chart kind
    metrics = main(["run", "--raw", raw, "--workdir", scratch_path(spark, "cli"), "--db", "t_cli"],
                   spark=spark)
    assert metrics["ingested_rows"] == 18 and metrics["clean_rows"] == 18 and metrics["q1_rows"] == 2


def test_ingest_stream_picks_up_new_raw_files(spark):
    from pyspark.sql import functions as F

    from chartwise.streaming.incremental import run_ingest_clean_streams
    raw = raw_charts(spark, SF)
    early = F.coalesce(F.col("date") < F.lit("1998"), F.lit(False))
    parts = [raw.filter(early), raw.filter(~early)]
    landing, split, out, ckpt = (scratch_path(spark, n) for n in ("land", "split", "out", "ckpt"))
    os.makedirs(landing)
    counts = []
    for i, part in enumerate(parts):
        staged = scratch_path(spark, f"stage{i}")
        write_raw_csv(part, staged)
        for f in os.listdir(staged):
            if f.endswith(".csv"):
                shutil.copy(os.path.join(staged, f), os.path.join(landing, f"{i}-{f}"))
        run_ingest_clean_streams(spark, landing, split, out, ckpt, CFG)
        counts.append(read_charts(spark, out).count())
    expected = clean(ingest(raw, CFG).drop("country_code", "month_str"), CFG.markets)
    assert 0 < counts[0] < counts[1] == 372
    assert _sorted(read_charts(spark, out).collect()) == _sorted(expected.collect())


def test_gates_fail_fast(spark):
    import pytest

    from chartwise.operators.quality import GateError
    from chartwise.schema import CHARTS_SCHEMA, REFERENCE_MARKETS, IngestConfig
    from chartwise.sources.catalog import register_table
    raw_csv = scratch_path(spark, "raw-gate")
    write_raw_csv(raw_charts(spark, SF), raw_csv)
    # DQ1: the fixture holds none of these market names
    with pytest.raises(GateError, match="ingest"):
        run_job(spark, raw_csv, scratch_path(spark, "gate-run"), IngestConfig(markets=REFERENCE_MARKETS),
                db="t_gate")
    # DQ2: an empty table is refused
    empty = scratch_path(spark, "empty")
    spark.createDataFrame([], CHARTS_SCHEMA).write.parquet(empty)
    with pytest.raises(RuntimeError, match="0 rows"):
        register_table(spark, empty, "t_gate", "empty_charts", partition_by=())
