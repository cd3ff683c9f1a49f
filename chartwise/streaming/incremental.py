"""Incremental ingest and cleaning with Structured Streaming.

* ``start_ingest_stream``: raw chart CSVs landing in a folder are filtered
  (chart kind, years, markets) and appended as split CSV files, one folder
  per (market, month).
* ``start_clean_stream``: split files (from the ingest stream or any other
  producer) are cleaned into the partitioned Parquet table.
 The file source remembers processed files in its checkpoint and the
file sink commits each micro-batch exactly once, so a re-run (or a restart
after a lost executor or driver) processes only files it has not seen.

``availableNow`` drains what is there now in bounded micro-batches
(``max_files_per_batch``) and stops - a batch job with memory. The cleaning
is the same stateless ``clean`` used in batch, so no state store is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartwise.operators.clean import clean
from chartwise.operators.ingest import ingest
from chartwise.schema import IngestConfig
from chartwise.sources.csv import CSV_WRITE_OPTIONS, read_raw_csv, read_split_csv


def _spread(df: DataFrame, keys: Sequence[str], salt_buckets: int | None) -> DataFrame:
    """Hash-partition a micro-batch on the folder keys plus a salt before a
    partitioned file sink: a batch then writes at most keys x buckets files
    (instead of one per task and key), and a key holding most of a batch is
    spread over that many tasks. (AQE, which balances the batch writes, does
    not run inside micro-batches, so the bound is explicit here.) By default
    as many buckets as a quarter of the session's parallel tasks: a hot key
    can then use a fair share of the cluster, whatever its size."""
    if salt_buckets is None:
        salt_buckets = max(2, df.sparkSession.sparkContext.defaultParallelism // 4)
    salt = F.pmod(F.xxhash64("date", "rank", "title", "artist"), F.lit(salt_buckets))
    return df.repartition(*[F.col(k) for k in keys], salt)


def start_ingest_stream(spark: SparkSession, raw_dir: str, split_dir: str, checkpoint: str, cfg: IngestConfig,
                        keys=("country_code", "month_str"), max_files_per_batch: int = 100,
                        salt_buckets: int | None = None, available_now: bool = True) -> StreamingQuery:
    """The layout of each batch is that of ``_spread`` on the split keys."""
    raw = read_raw_csv(spark, raw_dir, streaming=True, maxFilesPerTrigger=str(max_files_per_batch))
    kept = _spread(ingest(raw, cfg), keys, salt_buckets)
    w = (kept.writeStream.format("csv").options(**CSV_WRITE_OPTIONS)
         .option("checkpointLocation", checkpoint).partitionBy(*keys).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(split_dir)


def start_clean_stream(spark: SparkSession, split_dir: str, out_dir: str, checkpoint: str,
                       cfg: IngestConfig, partition_by=("region", "year"), max_files_per_batch: int = 1000,
                       salt_buckets: int | None = None, available_now: bool = True) -> StreamingQuery:
    raw = read_split_csv(spark, split_dir, streaming=True, maxFilesPerTrigger=str(max_files_per_batch))
    raw = raw.drop("country_code", "month_str")
    cleaned = _spread(clean(raw, cfg.markets, cfg.max_rank), partition_by, salt_buckets)
    w = (cleaned.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy(*partition_by).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_dir)


def _drain(q: StreamingQuery, timeout_s: float | None) -> None:
    done = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()
    if timeout_s is not None and not done:
        q.stop()  # what is committed stays; the next run goes on from there
        raise TimeoutError(f"the stream had not drained its input after {timeout_s} s")


def run_clean_stream(spark: SparkSession, split_dir: str, out_dir: str, checkpoint: str, cfg: IngestConfig,
                     timeout_s: float | None = None) -> None:
    _drain(start_clean_stream(spark, split_dir, out_dir, checkpoint, cfg), timeout_s)


def run_ingest_clean_streams(spark: SparkSession, raw_dir: str, split_dir: str, out_dir: str, checkpoint_dir: str,
                             cfg: IngestConfig, timeout_s: float | None = None) -> None:
    """Drain the ingest stream, then the clean stream over its output. Each
    keeps its own checkpoint under ``checkpoint_dir``; re-running picks up
    only raw files that arrived since."""
    base = checkpoint_dir.rstrip("/")
    _drain(start_ingest_stream(spark, raw_dir, split_dir, f"{base}/ingest", cfg), timeout_s)
    _drain(start_clean_stream(spark, split_dir, out_dir, f"{base}/clean", cfg), timeout_s)
