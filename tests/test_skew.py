"""A market holding most rows is written by several tasks, not one."""

import os

from pyspark.sql import functions as F

from chartwise.operators.clean import clean
from chartwise.operators.ingest import ingest
from chartwise.session import scratch_path
from chartwise.sources.catalog import read_charts, write_charts
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG
from chartwise.sources.fixtures import raw_charts


def test_hot_market_is_split_across_tasks(spark):
    charts = clean(ingest(raw_charts(spark, "/root/testdata/sf0.01"), CFG).drop("country_code", "month_str"),
                   CFG.markets)
    hot = charts.filter((F.col("region") == "JP") & (F.col("year") == 1998))
    # the hot (market, year) now holds far more rows than all others together
    skewed = charts.unionByName(hot.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("k"))
    # many input splits, as a large input has (a skewed partition can be cut
    # only between map outputs): materialise the input as 16 files
    staged = scratch_path(spark, "skew-input")
    skewed.repartition(16).write.parquet(staged)
    skewed = spark.read.parquet(staged)
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
        path = scratch_path(spark, "skewed")
        write_charts(skewed, path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    local = path[len("file:"):] if path.startswith("file:") else path
    hot_dir = os.path.join(local, "region=JP", "year=1998")
    files = [f for f in os.listdir(hot_dir) if f.startswith("part-")]
    assert len(files) > 2  # the hot folder was written by several tasks
    assert read_charts(spark, path).count() == skewed.count()


def test_a_hot_market_from_one_map_task_is_cut(spark, tmp_dir, monkeypatch):
    """A gzip file is one task; its hot market is written by several all the same."""
    import gzip

    from chartwise.plans import runner
    from chartwise.schema import IngestConfig
    raw = os.path.join(tmp_dir, "raw.csv.gz")
    with gzip.open(raw, "wt") as f:
        f.write("date,region,chart,trend,rank,title,artist,streams,url\n")
        for k in range(20_000):
            market = "Japan" if k % 10 else "Taiwan"
            f.write(f"2018-{k % 12 + 1:02d}-{k % 28 + 1:02d},{market},top200,x,{k % 200 + 1},song {k * 7919 % 10007},artist {k * 104729 % 9973},{k + 1},https://example.com/{k * 15485863 % 99991}\n")
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    monkeypatch.setattr(runner, "CUT_ROWS", 3000)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        res = runner.run_job(spark, raw, scratch_path(spark, "gz"), IngestConfig(), db="t_gz", min_markets=1)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert res.metrics["clean_rows"] == 20_000 == res.charts.count()
    files = res.charts.filter("region = 'JP'").select(F.input_file_name().alias("f"), "date").groupBy("f").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).orderBy("lo").collect()
    assert len(files) >= 4
    assert sum(a.hi > b.lo for a, b in zip(files[:-1], files[1:], strict=True)) <= 1  # cut by date
