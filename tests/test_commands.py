"""Each command alone, on what the one before wrote."""

import os

import pytest

from chartwise.__main__ import main
from chartwise.plans.series import series_cross_market, series_longevity
from chartwise.schema import Q1_SCHEMA, Q2_SCHEMA, REFERENCE_MARKETS, IngestConfig, Market
from chartwise.session import scratch_path
from chartwise.sources.catalog import write_charts
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG
from chartwise.sources.fixtures import raw_charts
from chartwise.operators.clean import clean
from chartwise.operators.ingest import ingest
from chartwise.streaming.incremental import run_clean_stream

SF = "/root/testdata/sf0.001"


def test_steps_one_by_one(spark, tmp_dir, capsys):
    raw = os.path.join(tmp_dir, "charts.csv")
    with open(raw, "w") as f:
        f.write("date,region,chart,trend,rank,title,artist,streams,url\n")
        for day in range(1, 4):
            for region in ("Japan", " taiwan", "Hong Kong", "Brazil"):
                f.write(f"2018-01-0{day} 00:00:00,{region},top200,SAME_POSITION,1,Song A,Artist,1000.0,u\n")
        f.write("2018-01-01,Japan\n")
    at = scratch_path(spark, "steps")
    assert main(["ingest", "--raw", raw, "--out", f"{at}/split"], spark) == {
        "raw_rows": 13, "bad_records": 1, "chart_rows": 12, "ingested_rows": 9, "complete_rows": 9, "clean_rows": 9}
    assert main(["clean", "--split", f"{at}/split", "--out", f"{at}/clean"], spark) == {"clean_rows": 9}
    assert main(["register", "--charts", f"{at}/clean", "--db", "t_steps"], spark) == {"table_rows": 9}
    assert "JP\t3" in capsys.readouterr().out
    assert main(["ask", "--charts", f"{at}/clean", "--out", f"{at}/results"], spark) == {"q1_rows": 1, "q2_rows": 3, "q3_rows": 1}
    assert main(["series", "--results", f"{at}/results", "--out", f"{at}/series"], spark) == {
        "cross_market_rows": 1, "longevity_rows": 3, "yearly_rows": 1}
    assert os.listdir(f"{at}/series/yearly")


def test_counts_beyond_32_bits(spark):
    q1 = spark.createDataFrame([("t", "a", 3, 3_000_000_000)], Q1_SCHEMA)
    assert series_cross_market(q1).first().total_appearances == 3_000_000_000
    q2 = spark.createDataFrame([("JP", "t", "a", 3_000_000_000, None)], Q2_SCHEMA)
    row = series_longevity(q2, REFERENCE_MARKETS).first()
    assert row.days_on_chart == 3_000_000_000 and row.best_rank == 0 and row.badge is None


def test_markets_are_named_once():
    with pytest.raises(ValueError, match="more than once"):
        IngestConfig(markets=(Market("japan", "JP", "Japan", 1), Market("japan", "JQ", "Japan", 2)))


def test_written_charts_are_snappy(spark):
    import glob

    import pyarrow.parquet as pq
    path = scratch_path(spark, "codec")
    write_charts(clean(ingest(raw_charts(spark, SF), CFG).drop("country_code", "month_str"), CFG.markets), path)
    files = glob.glob(f"{path}/**/*.parquet", recursive=True)
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
    assert files and codecs == {"SNAPPY"}


def test_a_stream_that_does_not_drain_in_time_raises(spark):
    from chartwise.sources.csv import write_split_csv
    split = scratch_path(spark, "slow-split")
    write_split_csv(ingest(raw_charts(spark, SF), CFG), split)
    with pytest.raises(TimeoutError):
        run_clean_stream(spark, split, scratch_path(spark, "slow-out"), scratch_path(spark, "slow-ckpt"), CFG, timeout_s=0.001)
    assert not spark.streams.active


def test_clean_stream_writes_few_files(spark):
    import glob

    from chartwise.sources.csv import write_split_csv
    split, out = scratch_path(spark, "few-split"), scratch_path(spark, "few-out")
    write_split_csv(ingest(raw_charts(spark, SF), CFG), split)
    run_clean_stream(spark, split, out, scratch_path(spark, "few-ckpt"), CFG)
    files = glob.glob(f"{out}/**/*.parquet", recursive=True)
    buckets = max(2, spark.sparkContext.defaultParallelism // 4)
    assert len(files) <= 25 * buckets
