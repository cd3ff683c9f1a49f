"""Streams as segments: exact ledgers, bounded files, safe merges."""

import glob
import json
import os

import pytest
from chartwise.operators import sift
from chartwise.schema import IngestConfig
from chartwise.session import scratch_path
from chartwise.streaming import segments as S

HEADER = "date,region,chart,trend,rank,title,artist,streams,url\n"


def land(folder, k, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/f{k:03d}.csv", "w") as f:
        f.write(HEADER + "\n".join(lines) + "\n")
    os.utime(f.name, (10**9 + k, 10**9 + k))


def line(k, market="Japan", url="u"):
    return f"2018-01-{k % 28 + 1:02d},{market},top200,NEW_ENTRY,1,t{k},a,5,{url}"


def data_files(base):
    return glob.glob(f"{base}/**/*.parquet", recursive=True)


def test_fifty_batches_leave_few_files_and_exact_counts(spark):
    cfg, got = IngestConfig(), S.Segments(spark, scratch_path(spark, "seg"), fan=4)
    for k in range(50):
        rows = [(*line(k).split(","), None), (*line(k, "Brazil").split(","), None), (*[None] * 9, "2018-01-01,Japan")]
        schema = HEADER.strip().replace(",", " string, ") + " string, _bad_record string"
        got.write_batch(spark.createDataFrame(rows, schema).coalesce(1), k, cfg)
        while got.compact():
            pass
    assert got.counts() == {"kept": 50, "market": 50, "bad record": 50}
    live = got.live()
    assert len(live) <= 3 * 4 and [s["first"] for s in live] == sorted(s["first"] for s in live)
    assert sum(s["last"] - s["first"] + 1 for s in live) == 50
    # live segments and those of the snapshot before, however many batches came
    assert len(data_files(got.base)) < 40 and len(os.listdir(f"{got.base}/batches")) <= 8
    assert got.rows().count() == 150 and S.clean_charts(got, cfg).count() == 50 and sift.defects(got.rows()).count() == 50


def test_bad_records_of_a_stream_are_kept_and_counted(spark, tmp_dir):
    landing, base, ckpt = f"{tmp_dir}/in", scratch_path(spark, "seg"), scratch_path(spark, "seg-ckpt")
    for k in range(3):
        land(landing, k, [line(k), line(k, "Brazil"), "2018-01-01,Japan", line(k, url='"never closed'), line(k, url='"two\nlines"')])
    got = S.run_segment_stream(spark, landing, base, ckpt, IngestConfig(), max_files_per_batch=2, fan=2)
    assert got.counts() == {"kept": 6, "market": 3, "bad record": 6}
    charts = S.clean_charts(got, IngestConfig())
    assert charts.count() == 6 and {r.url for r in charts.select("url").distinct().collect()} == {"u", "two\nlines"}
    assert sorted({r.record for r in sift.defects(got.rows()).collect()}) == ["2018-01-01,Japan", *sorted(line(k, url='"never closed') for k in range(3))]


def test_new_files_only_and_other_headers(spark, tmp_dir):
    landing, base, ckpt = f"{tmp_dir}/in", scratch_path(spark, "seg"), scratch_path(spark, "seg-ckpt")
    land(landing, 0, [line(1), line(2)])
    assert S.run_segment_stream(spark, landing, base, ckpt, IngestConfig()).counts() == {"kept": 2}
    land(landing, 1, [line(3)])
    with open(f"{landing}/g.csv", "w") as f:
        f.write("url,streams,artist,title,rank,trend,chart,region,date\nu,5,a,t9,1,x,top200,Taiwan,2018-01-05\n")
    got = S.run_segment_stream(spark, landing, base, ckpt, IngestConfig())
    assert got.counts() == {"kept": 4}
    assert {(r.title, r.region) for r in S.clean_charts(got, IngestConfig()).collect()} == {("t1", "JP"), ("t2", "JP"), ("t3", "JP"), ("t9", "TW")}


def test_a_batch_that_runs_again_counts_once(spark, tmp_dir):
    cfg, got = IngestConfig(), S.Segments(spark, scratch_path(spark, "seg"), fan=2)
    raw = lambda *ks: spark.createDataFrame([tuple(line(k).split(",")) for k in ks], HEADER.strip().replace(",", " string, ") + " string")
    got.write_batch(raw(1, 2), 0, cfg)
    got.write_batch(raw(3), 1, cfg)
    got.write_batch(raw(3), 1, cfg)  # its first commit was lost
    assert got.counts() == {"kept": 3} and got.compact() and not got.compact()
    got.write_batch(raw(3), 1, cfg)  # merged before its commit was known
    got.write_batch(raw(4), 2, cfg)
    assert got.counts() == {"kept": 4} and sorted(r.title for r in got.rows().collect()) == ["t1", "t2", "t3", "t4"]


def test_a_merge_that_dies_changes_nothing(spark, monkeypatch):
    cfg, got = IngestConfig(), S.Segments(spark, scratch_path(spark, "seg"), fan=2)
    for k in range(2):
        got.write_batch(spark.createDataFrame([tuple(line(k).split(","))], HEADER.strip().replace(",", " string, ") + " string"), k, cfg)
    reader = got.rows()

    def dies(*a):
        raise KeyboardInterrupt

    monkeypatch.setattr(S, "write_small_file", dies)
    with pytest.raises(KeyboardInterrupt):
        got.compact()
    monkeypatch.undo()
    assert got.counts() == {"kept": 2} and got.rows().count() == 2 and got.snapshot() == []
    assert got.compact() and got.rows().count() == 2 and reader.count() == 2  # a reader that began before
    assert json.load(open(f"{got.base}/snapshot.json"))["segments"][0]["counts"] == {"kept": 2}
    assert S.Segments(spark, scratch_path(spark, "none")).rows() is None


@pytest.mark.parametrize("rows, files, batch", [(1000, 8, 2), (300, 20, 5)])
def test_landing_files_of_the_queries_grow_in_number_with_the_rows(spark, monkeypatch, rows, files, batch):
    from chartwise import registry

    sf001, seen, real = "/root/testdata/sf0.001", {}, registry.run_segment_stream

    def watched(spark, landing, *args, **kw):
        seen.update(files=len(glob.glob(f"{landing}/*.csv")), batch=kw["max_files_per_batch"])
        return real(spark, landing, *args, **kw)

    monkeypatch.setattr(registry, "LANDING_ROWS", rows)
    monkeypatch.setattr(registry, "run_segment_stream", watched)
    assert registry.table(spark, sf001, "lineitem").count() == 6000
    got = registry.stream_ledger(spark, sf001)
    assert seen == {"files": files, "batch": batch} and got.agg({"rows": "sum"}).first()[0] == registry._raw(spark, sf001).count()
