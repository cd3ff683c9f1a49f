"""Handmade raw-chart files: quoting, casts, bad values, header checks."""

import os

import pytest
from pyspark.sql import functions as F

from chartwise.operators.clean import clean
from chartwise.operators.ingest import ingest
from chartwise.schema import REFERENCE_MARKETS, IngestConfig
from chartwise.sources.csv import read_raw_csv

HEADER = "date,region,chart,trend,rank,title,artist,streams,url\n"


def write(tmp_dir, name, text):
    p = os.path.join(tmp_dir, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_doubled_quotes_and_backslash(spark, tmp_dir):
    p = write(tmp_dir, "a.csv", HEADER
              + '2017-01-01,Japan,top200,SAME_POSITION,1,"Say ""Hi"", World",A,100,u\n'
              + '2017-01-01,Japan,top200,SAME_POSITION,2,"a \\"" b",B,100,u\n')
    rows = read_raw_csv(spark, p).select("title", "artist").collect()
    assert [r.title for r in rows] == ['Say "Hi", World', 'a \\" b']
    assert [r.artist for r in rows] == ["A", "B"]


def test_casts_and_rejects(spark, tmp_dir):
    p = write(tmp_dir, "b.csv", HEADER
              + "2017-01-01,Japan,top200,NEW_ENTRY,5,t1,a,100.0,u\n"      # decimal streams -> 100
              + "2017-01-01,Japan,top200,NEW_ENTRY,5,t2,a,,u\n"           # empty streams -> dropped
              + "2017-13-01,Japan,top200,NEW_ENTRY,5,t3,a,10,u\n"         # bad date -> dropped
              + "2017-01-02, Japan ,top200,NEW_ENTRY,5,t4,a,10,u\n"       # padded region -> JP
              + "2017-01-02,Brazil,top200,NEW_ENTRY,5,t5,a,10,u\n"        # unknown region
              + "2017-01-02,Japan,top200,NEW_ENTRY,5,NA,a,10,u\n"         # title NA kept as text
              + "2017-01-02,Japan,top200,NEW_ENTRY,0,r0,a,10,u\n"
              + "2017-01-02,Japan,top200,NEW_ENTRY,1,r1,a,10,u\n"
              + "2017-01-02,Japan,top200,NEW_ENTRY,200,r200,a,10,u\n"
              + "2017-01-02,Japan,top200,NEW_ENTRY,201,r201,a,10,u\n"
              + "2017-01-02,Japan,top200,NEW_ENTRY,9,s-1,a,-1,u\n"
              + "2017-01-02,Japan,top200,NEW_ENTRY,9,s0,a,0,u\n"
              + "2017-01-02,Japan,top200,NEW_ENTRY,9,s1,a,1,u\n")
    raw = read_raw_csv(spark, p)
    out = {r.title: r for r in clean(raw, REFERENCE_MARKETS).collect()}
    assert out["t1"].streams == 100
    assert "t2" not in out and "t3" not in out
    assert out["t4"].region == "JP"
    assert out["t5"].region == "Brazil"  # clean is permissive on markets
    assert "NA" in out
    assert {"r1", "r200"} <= set(out) and not {"r0", "r201"} & set(out)
    assert "s1" in out and not {"s-1", "s0"} & set(out)
    assert out["t1"].year == 2017 and str(out["t1"].date) == "2017-01-01"
    kept = {r.title for r in ingest(raw, IngestConfig()).collect()}
    assert "t5" not in kept and "t4" in kept and "t3" not in kept


def test_columns_are_matched_by_header_name(spark, tmp_dir):
    p = write(tmp_dir, "c.csv", "Title,Rank,Date,Artist,URL,Region,Chart,Trend,Streams\n"
              "t,1,2017-01-01,a,u,Japan,top200,NEW_ENTRY,5\n")
    r = read_raw_csv(spark, p).first()
    assert (r.date, r.region, r.rank, r.title, r.artist, r.streams, r.url) == \
        ("2017-01-01", "Japan", "1", "t", "a", "5", "u")


def test_reordered_header_is_an_error_with_positional_schema(spark, tmp_dir):
    p = write(tmp_dir, "c.csv", "region,date,chart,trend,rank,title,artist,streams,url\n"
              "Japan,2017-01-01,top200,NEW_ENTRY,1,t,a,1,u\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, p, by_name=False).collect()


def test_files_disagreeing_on_order_are_read_by_their_headers(spark, tmp_dir):
    write(tmp_dir, "a.csv", HEADER + "2017-01-01,Japan,top200,NEW_ENTRY,1,t,a,1,u\n")
    write(tmp_dir, "b.csv", "region,date,chart,trend,rank,title,artist,streams,url\n"
          "Japan,2017-01-02,top200,NEW_ENTRY,1,t,a,1,u\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, tmp_dir, audited=False).collect()
    rows = read_raw_csv(spark, tmp_dir).collect()  # by each file's own header
    assert {(r.date, r.region) for r in rows} == {("2017-01-01", "Japan"), ("2017-01-02", "Japan")}


def test_missing_column_is_reported(spark, tmp_dir):
    p = write(tmp_dir, "d.csv", "date,region,chart\n2017-01-01,Japan,top200\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_raw_csv(spark, p)


def test_funnel_counts_never_increase(spark):
    from chartwise.operators.clean import funnel
    from chartwise.sources.fixtures import FIXTURE_CONFIG, raw_charts
    r = funnel(raw_charts(spark, "/root/testdata/sf0.001"), FIXTURE_CONFIG).first()
    seq = [r.raw_rows, r.chart_rows, r.ingested_rows, r.complete_rows, r.clean_rows]
    assert seq == [6000, 4067, 561, 458, 372]  # FIXTURES.md section 4
    assert seq == sorted(seq, reverse=True)


def test_int_text_beyond_double_precision_is_exact(spark):
    from chartwise.functions.casts import to_long_lenient
    df = spark.range(1).select(F.lit("9007199254740993").alias("s"), F.lit("12.9").alias("d"),
                               F.lit(" 7 ").alias("p"), F.lit("abc").alias("x"))
    r = df.select(*[to_long_lenient(c).alias(c) for c in df.columns]).first()
    assert r.s == 9007199254740993 and r.d == 12 and r.p == 7 and r.x is None
