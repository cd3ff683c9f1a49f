"""Records of raw CSV: put together from lines, none lost without a count."""

import csv
import io
import os
import random

import pytest
from chartwise.plans.runner import run_job
from chartwise.schema import IngestConfig
from chartwise.session import scratch_path
from chartwise.sources import framing
from chartwise.sources.csv import BAD_RECORD, audit_raw_csv, read_raw_csv
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER = "date,region,chart,trend,rank,title,artist,streams,url"
ROW = "2018-01-01,Japan,top200,NEW_ENTRY,{k},t{k},a,5,{url}"
ABC = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return os.path.join(folder, name)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def plain_leads_to(line, inside):
    """Where a line ends, one character at a time; None if it does not fit."""
    i, fresh = 0, not inside
    while i < len(line):
        c = line[i]
        if inside:
            if c == '"':
                if line[i + 1:i + 2] == '"':
                    i += 1
                elif i + 1 == len(line) or line[i + 1] == ",":
                    inside = False
                else:
                    return None
            fresh = False
        elif c == '"' and fresh:
            inside, fresh = True, False
        else:
            fresh = c == ","
        i += 1
    return inside


def test_lines_are_followed_through_their_quotes(spark):
    rng = random.Random(1)
    lines = ["".join(rng.choice('",ab"') for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = df.select("value", framing.leads_to(framing.OUTSIDE).alias("out"), framing.leads_to(framing.INSIDE).alias("in")).collect()
    end = {False: framing.OUTSIDE, True: framing.INSIDE, None: framing.MISFIT}
    for r in got:
        assert (r["out"], r["in"]) == (end[plain_leads_to(r.value, False)], end[plain_leads_to(r.value, True)]), r.value


@pytest.mark.parametrize("split", ["64b", "300b", "1m"])
def test_records_over_lines_and_splits_equal_a_csv_reader(spark, tmp_dir, split):
    rng = random.Random(split)
    word = lambda: rng.choice(["", "x", "two words", 'say "hi"', "a,b", "line\nbreak", '\n\n"', "cr\r\nlf", ",", '",\n"', "12"])
    rows = []
    for name in ("a.csv", "b.csv"):
        own = [[word() or "z", word() + "m", word() + "n"] for _ in range(150)]
        out = io.StringIO()
        w = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
        w.writerow("abc")
        w.writerows(own)
        put(tmp_dir, name, out.getvalue())
        rows += own
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = read_raw_csv(spark, tmp_dir, schema=ABC, bad_records="keep")
        found = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r for r in found if r[BAD_RECORD] is not None] == []
    assert sorted((r.a, r.b, r.c) for r in found) == sorted(map(tuple, rows))


def test_a_quote_never_closed_takes_no_other_record(spark, tmp_dir):
    lines = [ROW.format(k=k, url="u") for k in range(1, 8)]
    lines[0] = ROW.format(k=1, url='"http')
    path = put(tmp_dir, "r.csv", "\n".join([HEADER, *lines, ""]))
    found = audit_raw_csv(spark, path)
    assert (found.files, found.lines, found.open_lines, found.misfits, found.header_lines, found.uniform) == (1, 8, 1, 1, 1, True)
    for multi_line in (True, False):
        kept = read_raw_csv(spark, path, multi_line=multi_line, bad_records="keep").collect()
        assert sorted(r.title for r in kept if r[BAD_RECORD] is None) == [f"t{k}" for k in range(2, 8)]
        assert [r[BAD_RECORD] for r in kept if r[BAD_RECORD] is not None] == [lines[0]]
        with pytest.raises(Exception, match="bad record"):
            read_raw_csv(spark, path, multi_line=multi_line, bad_records="fail").collect()
    with pytest.raises(Exception, match="bad record"):
        run_job(spark, path, scratch_path(spark, "strict"), IngestConfig(), db="t_frame_strict", bad_records="fail")
    res = run_job(spark, path, scratch_path(spark, "open"), IngestConfig(), db="t_frame", min_markets=1)
    assert res.metrics["bad_records"] == 1 and res.metrics["raw_rows"] == 7 and res.metrics["clean_rows"] == 6


def test_a_break_in_the_last_column(spark, tmp_dir):
    path = put(tmp_dir, "r.csv", f'{HEADER}\n{ROW.format(k=1, url=chr(34) + "http" + chr(10) + "more" + chr(34))}\n{ROW.format(k=2, url="u")}\n')
    assert rows_of(read_raw_csv(spark, path), "title", "url") == [("t1", "http\nmore"), ("t2", "u")]
    single = read_raw_csv(spark, path, multi_line=False, bad_records="keep").collect()
    assert sorted(r[BAD_RECORD] or "" for r in single) == ["", ROW.format(k=1, url='"http'), 'more"']


def test_headers_of_files_may_differ(spark, tmp_dir):
    put(tmp_dir, "a.csv", 'a,b,c\n1,"x\ny",3\n')
    put(tmp_dir, "b.csv", '\ufeffC ,"B",A,more\n3,2,9,0\n\nC ,"B",A,more\n8,2\n')
    got = read_raw_csv(spark, tmp_dir, schema=ABC, bad_records="keep").collect()
    assert sorted(((r.a, r.b, r.c) if r[BAD_RECORD] is None else r[BAD_RECORD] for r in got), key=str) == [("1", "x\ny", "3"), ("9", "2", "3"), "8,2"]
    with pytest.raises(ValueError, match="lacks columns"):
        put(tmp_dir, "c.csv", "a,b\n1,2\n")
        read_raw_csv(spark, tmp_dir, schema=ABC)


def test_both_readers_agree_on_clean_files(spark, tmp_dir):
    path = put(tmp_dir, "a.csv", 'a,b,c\n1,"q ""x"", y",\n"",b 12" mix,"z,"\n  p ,"", r\n')
    spark_own = read_raw_csv(spark, path, schema=ABC, audited=False, multi_line=False)
    assert audit_raw_csv(spark, path).clean
    records = framing.framed_records(spark, path)
    assert records.filter(~F.col("fits")).count() == 0
    put(tmp_dir, "b.csv", 'b,a,c\n"one\ntwo",2,3\n')  # makes the folder take the other way
    both = read_raw_csv(spark, tmp_dir, schema=ABC)
    assert rows_of(both, *"abc") == sorted([*rows_of(spark_own, *"abc"), ("2", "one\ntwo", "3")], key=str)


def test_empty_paths(spark, tmp_dir):
    assert read_raw_csv(spark, put(tmp_dir, "a.csv", "a,b,c\n"), schema=ABC).collect() == []
    found = audit_raw_csv(spark, put(os.path.join(tmp_dir, "x"), "b.csv", ""))
    assert found.lines == 0 and found.clean
