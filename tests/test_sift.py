"""Every raw row has one fate, counted in files; runs publish whole versions."""

import glob
import os
import subprocess
import sys
import textwrap

import pytest
from chartwise.operators import sift
from chartwise.operators.quality import GateError
from chartwise.plans import runner
from chartwise.plans.runner import answers_of, run_job
from chartwise.plans.stages import Stages, input_listing
from chartwise.schema import IngestConfig
from chartwise.session import read_small_file, scratch_path, write_small_file
from chartwise.sources.catalog import write_charts
from chartwise.sources.csv import read_raw_csv, write_raw_csv
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG
from chartwise.sources.fixtures import raw_charts
from chartwise.operators.clean import clean
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEADER = "date,region,chart,trend,rank,title,artist,streams,url\n"


@pytest.fixture()
def raw(tmp_dir):
    path = os.path.join(tmp_dir, "raw.csv")
    with open(path, "w") as f:
        f.write(HEADER)
        for market in ("Japan", "Taiwan", "Vietnam"):
            f.write(f"2018-01-01,{market},top200,NEW_ENTRY,1,t,A,10,u\n")
        f.write("2018-01-01,Japan,viral50,NEW_ENTRY,1,t,A,10,u\n" * 2)
        f.write("never,Japan,top200,NEW_ENTRY,1,t,A,10,u\n")
        f.write("2010-01-01,Japan,top200,NEW_ENTRY,1,t,A,10,u\n")
        f.write("2018-01-01,Atlantis,top200,NEW_ENTRY,1,t,A,10,u\n" + "2018-01-01,,top200,NEW_ENTRY,1,t,A,10,u\n")
        f.write("2018-01-01,Japan,top200,NEW_ENTRY,one,t,A,10,u\n" + "2018-01-01,Japan,top200,NEW_ENTRY,1,,A,10,u\n")
        f.write("2018-01-01,Japan,top200,NEW_ENTRY,201,t,A,10,u\n" + "2018-01-01,Japan,top200,NEW_ENTRY,2,t,A,0,u\n")
        f.write("2018-01-01,Japan\n" + '2018-01-01,Japan,top200,NEW_ENTRY,1,t,A,10,"u\n')
    return path


REASONS = {"kept": 3, "chart kind": 2, "date": 1, "years": 1, "market": 2, "incomplete": 2, "out of range": 2, "bad record": 2}


def test_reasons_add_up(spark, raw):
    path = scratch_path(spark, "sift")
    sift.write_sifted(read_raw_csv(spark, raw, bad_records="keep"), IngestConfig(), path)
    sifted = sift.read_sifted(spark, path)
    assert {r.reason: r.rows for r in sift.reason_counts(sifted).collect()} == REASONS
    defects = {(r.reason, r.record or r.rank) for r in sift.defects(sifted).collect()}
    assert defects == {("date", "1"), ("incomplete", "one"), ("incomplete", "1"), ("out of range", "201"), ("out of range", "2"),
                       ("bad record", "2018-01-01,Japan"), ("bad record", '2018-01-01,Japan,top200,NEW_ENTRY,1,t,A,10,"u')}
    assert sifted.filter(F.col("reason") == "market").select("region", "title").distinct().collect() == [(None, None)]  # out of scope: the reason alone


@pytest.mark.parametrize("split_files", [False, True])
def test_a_run_counts_exactly_and_again_when_skipped(spark, raw, split_files):
    work = scratch_path(spark, "exact")
    for _ in range(2):
        res = run_job(spark, raw, work, IngestConfig(), db=f"t_exact_{split_files}", split_files=split_files)
        assert not res.approximate and res.rejects.count() == 7
        assert {k: v for k, v in res.metrics.items() if k.endswith("rows") or k == "bad_records"} == {
            "raw_rows": 15, "bad_records": 2, "chart_rows": 11, "ingested_rows": 7, "complete_rows": 5, "clean_rows": 3, "q1_rows": 1, "q2_rows": 3, "q3_rows": 1}
        assert sum(v for k, v in res.metrics.items() if k.startswith("rejected: ")) + res.metrics["clean_rows"] == res.metrics["raw_rows"]
    assert {"ingest", "clean", "q1"} <= set(res.skipped)


def test_counts_hold_when_tasks_run_twice(tmp_dir):
    """In a session of its own, where a task may fail once: each first attempt
    dies after it has given out all its rows."""
    code = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from chartwise.session import build_session
        spark = build_session("local[2,3]", shuffle_partitions=4, extra={{"spark.checkpoint.dir": {tmp_dir!r}, "spark.sql.warehouse.dir": {tmp_dir!r} + "/wh"}})
        from chartwise.operators import sift
        from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG, raw_charts
        from chartwise.plans.runner import run_job
        spark.sparkContext.setLogLevel("OFF")
        raw = raw_charts(spark, {SF!r}).repartition(3)
        def flaky(batches):
            from pyspark import TaskContext
            yield from batches
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")
        res = run_job(spark, raw.mapInArrow(flaky, raw.schema), {tmp_dir!r} + "/run", CFG, db="t_flaky")
        print("COUNTS", [res.metrics[k] for k in ("raw_rows", "chart_rows", "ingested_rows", "complete_rows", "clean_rows")])
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=300, check=False)
    assert "COUNTS [6000, 4067, 561, 458, 372]" in out.stdout, out.stderr[-3000:]


def test_a_run_killed_while_it_writes_leaves_the_old_table(spark, raw, monkeypatch):
    work = scratch_path(spark, "killed")
    run_job(spark, raw, work, IngestConfig(), db="t_killed")
    before = sorted(map(tuple, spark.table("t_killed.charts").collect()))

    def dies(df, path, **kw):
        write_charts(df.limit(1), path, **kw)
        os.remove(f"{path}/_SUCCESS")
        raise KeyboardInterrupt

    monkeypatch.setattr(runner, "write_charts", dies)
    with pytest.raises(KeyboardInterrupt):
        run_job(spark, raw, work, IngestConfig(max_rank=201), db="t_killed")
    assert sorted(map(tuple, spark.table("t_killed.charts").collect())) == before and len(before) == 3
    monkeypatch.undo()
    res = run_job(spark, raw, work, IngestConfig(max_rank=201), db="t_killed")
    assert res.metrics["clean_rows"] == 4 == spark.table("t_killed.charts").count()
    run_job(spark, raw, work, IngestConfig(), db="t_killed")
    assert spark.table("t_killed.charts").count() == 3
    assert len(os.listdir(f"{work}/clean")) == 2  # this version and the one before


def test_a_truncated_result_fails_its_gate(spark, tmp_dir):
    raw_csv, work = scratch_path(spark, "raw"), scratch_path(spark, "cut")
    write_raw_csv(raw_charts(spark, SF), raw_csv)
    run_job(spark, raw_csv, work, CFG, db="t_cut")
    [part] = glob.glob(f"{work}/results/q2/part-*.csv")
    with open(part) as f:
        lines = f.readlines()
    for changed in (lines[:-3], [lines[0], lines[1].replace("\t1", "\t2", 1) + "", *lines[2:-1], lines[-2]]):
        with open(part, "w") as f:
            f.writelines(changed)
        crc = os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
        with pytest.raises(GateError, match="q2: the result file"):
            run_job(spark, raw_csv, work, CFG, db="t_cut")


def test_q1_with_a_market_that_is_not_listed(spark):
    rows = [("2018-01-01", m, "top200", "x", "1", "t", "a", "5", "u") for m in ("Japan", "Taiwan", "Atlantis", "Atlantis")]
    charts = clean(spark.createDataFrame(rows, "date string, region string, chart string, trend string, rank string, title string, artist string, streams string, url string"),
                   IngestConfig().markets)
    assert [tuple(r) for r in answers_of(charts, IngestConfig())["q1"].collect()] == [("t", "a", 3, 4)]


def test_listing_tells_changes_and_ignores_order(spark, tmp_dir):
    for k in range(300):
        os.makedirs(f"{tmp_dir}/in/d{k % 7}/k={k % 3}", exist_ok=True)
        with open(f"{tmp_dir}/in/d{k % 7}/k={k % 3}/f{k}.csv", "w") as f:
            f.write("x" * (k + 1))
        os.utime(f.name, (10**9, 10**9 + k))
    first = input_listing(spark, f"{tmp_dir}/in")
    assert first == input_listing(spark, f"{tmp_dir}/in") and first[:2] == (300, sum(range(301)))
    os.utime(f"{tmp_dir}/in/d0/k=0/f0.csv", (10**9, 10**9 + 5000))
    touched = input_listing(spark, f"{tmp_dir}/in")
    assert touched != first and touched[:2] == first[:2]
    assert input_listing(spark, f"{tmp_dir}/in/d1/k=1/f1.csv")[0] == 1 and input_listing(spark, f"{tmp_dir}/in/d*/k=1")[0] == 100


def test_records_are_replaced_in_one_step(spark):
    base = scratch_path(spark, "records")
    stages = Stages(spark, base)
    assert not stages.done("a", base, "m") and stages.counts("a") == {}
    stages.starting("a")
    stages.finished("a", "m", {"n": 1}, output=f"{base}/out")
    assert (stages.counts("a"), stages.output("a")) == ({"n": 1}, f"{base}/out") and not stages.done("a", f"{base}/out", "m")  # nothing committed there
    write_small_file(spark, f"{base}/out/_SUCCESS", "")
    assert stages.done("a", f"{base}/out", "m") and not stages.done("a", f"{base}/out", "other")
    assert read_small_file(spark, f"{base}/none") is None and [n for n in os.listdir(f"{base}/stages") if n.endswith(".tmp")] == []
