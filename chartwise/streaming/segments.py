"""A stream's rows as segments, with a ledger of its batches.

A Spark file sink appends files for ever and says nothing of the rows it left
out. Here each micro-batch is sifted (``operators.sift``): one folder holds all
its rows with their reasons, and a small record counts them, bad records
included. A batch that runs again after a failure overwrites its own folder and
record, so every file is counted and kept once.

``compact`` merges segments of a kind: ``FAN`` batches into one segment of level
1, ``FAN`` of these into one of level 2, and so on, so a row is rewritten a
logarithmic number of times and there are at most ``FAN`` segments a level. The
live segments stand in one small file, replaced in one step: a reader sees them
before a merge or after it. Folders that it no longer names go with the next
merge, not at once, as a reader may be at them still.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chartwise.operators import sift
from chartwise.operators.clean import clean
from chartwise.schema import IngestConfig
from chartwise.session import child_folders, done_marker, read_small_file, remove_path, write_small_file
from chartwise.sources.csv import read_raw_csv

FAN = 8


class Segments:
    """The segments below ``base``. ``snapshot``: the live merged segments,
    each with its level, first and last batch and counts by reason; batches
    after the last one of these are live by their own records."""

    def __init__(self, spark: SparkSession, base: str, fan: int = FAN):
        self.spark, self.base, self.fan = spark, base.rstrip("/"), fan

    # --- batches

    def batch_folder(self, batch: int) -> str:
        return f"{self.base}/batches/{batch:012d}"

    def write_batch(self, raw: DataFrame, batch: int, cfg: IngestConfig) -> None:
        if batch <= self.merged_through():
            return  # merged already: the batch was committed before
        folder = self.batch_folder(batch)
        sift.write_sifted(raw, cfg, f"{folder}/rows")
        counts = {r.reason: r.rows for r in sift.reason_counts(sift.read_sifted(self.spark, f"{folder}/rows")).collect()}
        write_small_file(self.spark, f"{folder}/counts.json", json.dumps(counts))

    def batches(self) -> dict[int, dict[str, int]]:
        """Counts by reason of each batch that is not merged yet."""
        out, through = {}, self.merged_through()
        for folder in child_folders(self.spark, f"{self.base}/batches"):
            batch = int(folder.rstrip("/").rsplit("/", 1)[-1])
            if batch > through and (text := read_small_file(self.spark, f"{folder}/counts.json")):
                out[batch] = json.loads(text)
        return dict(sorted(out.items()))

    # --- segments

    def snapshot(self) -> list[dict]:
        text = read_small_file(self.spark, f"{self.base}/snapshot.json")
        return json.loads(text)["segments"] if text else []

    def merged_through(self) -> int:
        return max((s["last"] for s in self.snapshot()), default=-1)

    def live(self) -> list[dict]:
        """All live segments, oldest first."""
        own = [{"folder": f"{self.batch_folder(b)}/rows", "level": 0, "first": b, "last": b, "counts": c} for b, c in self.batches().items()]
        return sorted([*self.snapshot(), *own], key=lambda s: s["first"])

    def counts(self) -> dict[str, int]:
        """Rows by reason over all batches: they add up to the rows read."""
        total: Counter = Counter()
        for s in self.live():
            total.update(s["counts"])
        return dict(total)

    def rows(self) -> DataFrame | None:
        """All sifted rows; None before the first batch."""
        folders = [s["folder"] for s in self.live() if sum(s["counts"].values())]
        return self.spark.read.parquet(*folders) if folders else None

    def compact(self) -> bool:
        """Merge the oldest ``fan`` neighbouring segments of the lowest level
        that has so many; whether there was anything to merge."""
        live = self.live()
        for level in sorted({s["level"] for s in live}):
            same = [s for s in live if s["level"] == level]
            if len(same) < self.fan:
                continue
            merge = same[:self.fan]
            folder = f"{self.base}/merged/{merge[0]['first']:012d}-{merge[-1]['last']:012d}-{uuid.uuid4().hex[:8]}"
            counts: Counter = Counter()
            for s in merge:
                counts.update(s["counts"])
            some = [s["folder"] for s in merge if sum(s["counts"].values())]
            if some:
                self.spark.read.parquet(*some).hint("rebalance").write.parquet(folder)
                if not done_marker(self.spark, folder):
                    raise RuntimeError(f"{folder} was not committed")
            whole = {"folder": folder, "level": level + 1, "first": merge[0]["first"], "last": merge[-1]["last"], "counts": dict(counts)}
            before = self.snapshot()
            gone = {s["folder"] for s in merge}
            after = sorted([*(s for s in before if s["folder"] not in gone), whole], key=lambda s: s["first"])
            write_small_file(self.spark, f"{self.base}/snapshot.json", json.dumps({"segments": after}))
            self._tidy({s["folder"] for s in before} | gone | {folder})
            return True
        return False

    def _tidy(self, keep: set[str]) -> None:
        """Remove what neither this snapshot nor the one before it names."""
        names = {k.split("/batches/")[-1].split("/")[0] if "/batches/" in k else k.rsplit("/", 1)[-1] for k in keep | {s["folder"] for s in self.snapshot()}}
        through = self.merged_through()
        for folder in child_folders(self.spark, f"{self.base}/merged"):
            if folder.rstrip("/").rsplit("/", 1)[-1] not in names:
                remove_path(self.spark, folder)
        for folder in child_folders(self.spark, f"{self.base}/batches"):
            name = folder.rstrip("/").rsplit("/", 1)[-1]
            if int(name) <= through and name not in names:
                remove_path(self.spark, folder)


def start_segment_stream(spark: SparkSession, raw_dir: str, base: str, checkpoint: str, cfg: IngestConfig, max_files_per_batch: int = 100,
                         multi_line: bool = True, available_now: bool = True, fan: int = FAN) -> StreamingQuery:
    """Raw CSV files landing in a folder -> segments, merged as they come.

    The stream itself only names the files of a batch (``max_files_per_batch``
    at most); these are then read as in a batch job, audited line by line, so
    line breaks in quoted fields, quotes never closed and headers in another
    order are dealt with alike."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary") \
        .option("maxFilesPerTrigger", str(max_files_per_batch)).load(raw_dir).select("path")
    segments = Segments(spark, base, fan)

    def each(batch: DataFrame, number: int) -> None:
        paths = sorted(r.path for r in batch.collect())
        if paths:
            segments.write_batch(read_raw_csv(spark, paths, bad_records="keep", multi_line=multi_line), number, cfg)
        while segments.compact():
            pass

    w = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_segment_stream(spark: SparkSession, raw_dir: str, base: str, checkpoint: str, cfg: IngestConfig, max_files_per_batch: int = 100,
                       timeout_s: float | None = None, fan: int = FAN) -> Segments:
    """Drain what has landed."""
    from chartwise.streaming.incremental import _drain

    _drain(start_segment_stream(spark, raw_dir, base, checkpoint, cfg, max_files_per_batch, fan=fan), timeout_s)
    return Segments(spark, base, fan)


def clean_charts(segments: Segments, cfg: IngestConfig) -> DataFrame:
    """Clean charts of all batches so far."""
    rows = segments.rows()
    if rows is None:
        raise RuntimeError(f"no batch below {segments.base}")
    return clean(sift.kept(rows), cfg.markets, cfg.max_rank)
