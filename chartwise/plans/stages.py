"""Stage bookkeeping of a run: what was made, from what, with what settings.

A stage's output counts as done only if Spark committed it (``_SUCCESS``) and
the stage's fingerprint is on record: a hash of its settings, of the input
files (names, sizes, times) and of the fingerprint of the stage before. The
record is written last, after the stage's gate, so a stage that failed its gate,
or whose settings or input changed, runs again.

A record is one small file, written beside its place and renamed onto it in one
step, without a Spark job; counts of a stage are kept in it, so that a re-run
that skips the stage still reports them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from chartwise.session import child_folders, done_marker, read_small_file, remove_path, write_small_file


def fingerprint(**what) -> str:
    return hashlib.sha256(json.dumps(what, sort_keys=True, default=str).encode()).hexdigest()


def input_listing(spark: SparkSession, path: str) -> tuple[int, int, str]:
    """What lies below ``path`` (file, folder or glob pattern): number of data
    files, their bytes, and a hash over every file's name, size and time that
    does not depend on their order. Executors hash the listing that Spark
    itself makes of any input; no content is read and no file is named on
    the driver."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    one = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    n, size, total = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum(one), F.lit(0).cast("decimal(38,0)"))).first()
    return n, int(size), str(total)


@dataclass
class Stages:
    spark: SparkSession
    base: str
    skipped: list[str] = field(default_factory=list)

    def _record(self, name: str) -> str:
        return f"{self.base}/stages/{name}.json"

    def _read(self, name: str) -> dict:
        text = read_small_file(self.spark, self._record(name))
        return json.loads(text) if text else {}

    def done(self, name: str, output: str, mark: str) -> bool:
        """Whether the output is that of exactly these settings and inputs."""
        if self._read(name).get("mark") != mark or not output or not done_marker(self.spark, output):
            return False
        self.skipped.append(name)
        return True

    def counts(self, name: str) -> dict[str, int]:
        """The counts that the finished stage left in its record."""
        return self._read(name).get("counts", {})

    def output(self, name: str) -> str | None:
        """Where the finished stage put its output, if it chose the place."""
        return self._read(name).get("output")

    def keep_versions(self, name: str, folder: str, keep: tuple[str, ...]) -> None:
        """Remove all other versions of a stage's output below ``folder``."""
        for path in child_folders(self.spark, folder):
            if path.rstrip("/").rsplit("/", 1)[-1] not in {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}:
                remove_path(self.spark, path)

    def starting(self, name: str) -> None:
        """The old record goes before the output is touched."""
        self._write(name, f"running {uuid.uuid4().hex}", {})

    def finished(self, name: str, mark: str, counts: dict | None = None, output: str | None = None) -> None:
        self._write(name, mark, counts or {}, output)

    def _write(self, name: str, mark: str, counts: dict, output: str | None = None) -> None:
        write_small_file(self.spark, self._record(name), json.dumps({"mark": mark, "counts": counts, "output": output}))
