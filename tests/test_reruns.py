"""A re-run skips only what would come out the same; a failed gate marks nothing."""

import os
from dataclasses import replace

import pytest

from chartwise.operators.quality import GateError
from chartwise.plans.runner import run_job
from chartwise.schema import REFERENCE_MARKETS, IngestConfig
from chartwise.session import scratch_path
from chartwise.sources.csv import write_raw_csv
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG
from chartwise.sources.fixtures import raw_charts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw_csv(spark):
    path = scratch_path(spark, "rerun-raw")
    write_raw_csv(raw_charts(spark, SF), path)
    return path


def test_changed_settings_and_input_give_fresh_answers(spark, raw_csv, tmp_dir):
    work = scratch_path(spark, "rerun")
    first = run_job(spark, raw_csv, work, CFG, db="t_rerun")
    assert not first.skipped
    other = run_job(spark, raw_csv, work, replace(CFG, leader_region="TW"), db="t_rerun", k_longevity=1)
    assert set(other.skipped) == {"ingest", "clean", "q1"}
    assert other.reloaded["q2"].count() == 5
    fresh = run_job(spark, raw_csv, scratch_path(spark, "fresh"), replace(CFG, leader_region="TW"), db="t_rerun2", k_longevity=1)
    for q in ("q2", "q3"):
        assert sorted(map(str, other.reloaded[q].collect())) == sorted(map(str, fresh.reloaded[q].collect()))
    years = run_job(spark, raw_csv, work, replace(CFG, year_to=1997), db="t_rerun", min_markets=1)
    assert not years.skipped and {r.year for r in years.reloaded["q3"].collect()} <= {1996, 1997}
    again = run_job(spark, raw_csv, work, replace(CFG, year_to=1997), db="t_rerun", min_markets=1)
    assert {"ingest", "clean", "q1", "q2", "q3", "series_yearly"} <= set(again.skipped)


def test_new_input_is_noticed(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    head = "date,region,chart,trend,rank,title,artist,streams,url\n"

    def add(name, title):
        with open(os.path.join(raw, name), "w") as f:
            f.write(head + "".join(f"2018-01-01,{m},top200,NEW_ENTRY,1,{title},A,10,u\n" for m in ("Japan", "Taiwan", "Vietnam")))

    add("a.csv", "one")
    work = scratch_path(spark, "grow")
    assert run_job(spark, raw, work, IngestConfig(), db="t_grow").metrics["q1_rows"] == 1
    add("b.csv", "two")
    assert run_job(spark, raw, work, IngestConfig(), db="t_grow").metrics["q1_rows"] == 2


@pytest.mark.parametrize("split_files", [False, True])
def test_a_failed_gate_can_be_mended(spark, raw_csv, split_files):
    work, db = scratch_path(spark, "mend"), f"t_mend_{split_files}"
    with pytest.raises(GateError, match="ingest"):  # the fixture has none of these markets
        run_job(spark, raw_csv, work, IngestConfig(markets=REFERENCE_MARKETS), db=db, split_files=split_files)
    with pytest.raises(GateError, match="q1"):  # no song is in so many markets
        run_job(spark, raw_csv, work, CFG, db=db, split_files=split_files, min_markets=6)
    res = run_job(spark, raw_csv, work, CFG, db=db, split_files=split_files)
    assert {"ingest", "clean"} <= set(res.skipped) and res.metrics["q1_rows"] == 30


def test_clean_gate(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "r.csv")
    with open(raw, "w") as f:
        f.write("date,region,chart,trend,rank,title,artist,streams,url\n2018-01-01,Japan,top200,NEW_ENTRY,1,t,A,0,u\n")
    for split_files in (False, True):
        with pytest.raises(GateError, match="clean"):
            run_job(spark, raw, scratch_path(spark, "cg"), IngestConfig(), db="t_cg", split_files=split_files)
