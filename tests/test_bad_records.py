"""Records that do not fit are seen, counted and kept out; nothing else is lost."""

import os

import pytest

from chartwise.plans.runner import run_job
from chartwise.schema import IngestConfig
from chartwise.session import scratch_path
from chartwise.sources.csv import BAD_RECORD, is_bad, read_raw_csv, read_split_csv
from chartwise.sources.results import read_noisy_lines, read_result_tsv
from pyspark.sql import types as T

HEADER = "date,region,chart,trend,rank,title,artist,streams,url\n"
GOOD = "2018-01-0{d},{m},top200,SAME_POSITION,{r},{t},A,1000,u\n"


@pytest.fixture()
def raw(tmp_dir):
    path = os.path.join(tmp_dir, "charts.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER)
        for m in ("Japan", "Taiwan", "Hong Kong"):
            for d in range(1, 5):
                f.write(GOOD.format(d=d, m=m, r=1, t="plain"))
                f.write(GOOD.format(d=d, m=m, r=2, t='"two\nlines, ""quoted"""'))
        f.write("2018-01-01,Japan,top200\n")  # too short
        f.write("2018-01-01,Japan,top200,NEW_ENTRY,3,t,A,5,u,and one more\n")  # too long
    return path


def test_each_way_to_treat_bad_records(spark, raw):
    kept = read_raw_csv(spark, raw, multi_line=True, bad_records="keep")
    assert kept.count() == 26 and kept.filter(is_bad("date")).count() == 2
    assert read_raw_csv(spark, raw, multi_line=True).count() == len(read_raw_csv(spark, raw, multi_line=True).collect()) == 24
    with pytest.raises(Exception, match="bad record"):
        read_raw_csv(spark, raw, multi_line=True, bad_records="fail").collect()
    # without multi_line each broken title makes two bad records, and none comes through shifted
    single = read_raw_csv(spark, raw, multi_line=False, bad_records="keep").collect()
    assert sum(r[BAD_RECORD] is None for r in single) == 12 and sum(r[BAD_RECORD] is not None for r in single) == 26
    assert {r.title for r in read_raw_csv(spark, raw, multi_line=False).collect()} == {"plain"}


def test_a_glob_is_read_by_name(spark, raw):
    assert read_raw_csv(spark, os.path.join(os.path.dirname(raw), "*.csv"), multi_line=True).count() == 24


@pytest.mark.parametrize("split_files", [False, True])
def test_split_and_fused_runs_agree_on_line_breaks(spark, raw, split_files):
    work = scratch_path(spark, "breaks")
    res = run_job(spark, raw, work, IngestConfig(), db=f"t_breaks_{split_files}", split_files=split_files, multi_line=True)
    assert res.metrics["bad_records"] == 2 and res.metrics["clean_rows"] == 24 and "clean_rows" not in res.approximate
    assert {r.title for r in res.reloaded["q1"].collect()} == {"plain", 'two\nlines, "quoted"'}
    if split_files:
        assert read_split_csv(spark, f"{work}/split").count() == 24


def test_strict_run_ends(spark, raw):
    with pytest.raises(Exception, match="bad record"):
        run_job(spark, raw, scratch_path(spark, "strict"), IngestConfig(), db="t_strict", multi_line=True, bad_records="fail")


RESULT = T.StructType([T.StructField("title", T.StringType()), T.StructField("n", T.LongType())])


def test_result_counts_are_those_of_the_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r.tsv")
    with open(path, "w") as f:
        f.write("title\tn\ntitle\t1\nsong\t2\nshort\nlong\t3\tx\nbad\tmany\n")
    df = read_result_tsv(spark, path, RESULT)
    rows = df.collect()
    assert sorted((r.title, r.n) for r in rows) == [("song", 2), ("title", 1)]  # a song called title stays
    assert df.count() == df.select("title").count() == df.select("n").count() == 2
    assert read_result_tsv(spark, path, RESULT, rejects=True).count() == 3


def test_noisy_lines_of_other_lengths(spark, tmp_dir):
    path = os.path.join(tmp_dir, "noisy.txt")
    with open(path, "w") as f:
        f.write("7\n1\ta\t2\n3\tb\n4\tc\t5\td\nn\tt\t6\nx\ty\tz\nOK 1\tq\t9\n")
    rows = read_noisy_lines(spark, path, ["n", "t", "m"], numeric=["n", "m"]).collect()
    assert sorted((r.n, r.t, r.m) for r in rows) == [(1.0, "a", 2.0), (3.0, "b", None)]
