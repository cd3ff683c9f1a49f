"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "chartwise", shuffle_partitions: int | None = None,
                  extra: dict | None = None, small_input: bool = False, wide_shuffles: bool = False) -> SparkSession:
    """Session with AQE on and the UI off. On a cluster, pass master=None and
    let spark-submit decide; partitions then come from the cluster config.
    Two settings are the caller's choice, never guessed from the master:
    ``small_input`` lists folders on the driver and lets AQE keep more,
    smaller partitions; ``wide_shuffles`` starts every shuffle wide."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split oversized partitions of the rebalance exchanges used before writes
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if small_input:
        # One JVM: a distributed file-listing job only adds scheduling cost,
        # so list partition folders on the driver. Clusters keep Spark's
        # default (parallel listing beyond 32 folders per level).
        conf["spark.sql.sources.parallelPartitionDiscovery.threshold"] = "100000"
        # Small inputs: let AQE keep more, smaller partitions so that work
        # per output file (a partitioned write creates one per folder and
        # task) spreads over all cores. Rebalance keeps one key in one task,
        # so this adds tasks, not files.
        conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "128k"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    if wide_shuffles and not shuffle_partitions and \
            spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None:
        # AQE can merge shuffle partitions but not add them: start every
        # shuffle wide (about four per core) so that even the largest one
        # yields partitions near the advisory size, and let AQE coalesce.
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                       str(max(2048, 4 * sc.defaultParallelism)))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins. Only a local-mode session without one (tests,
    laptops) gets a private temporary folder; on a cluster that would be a
    machine-local path, so it is refused instead.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a client session without a driver context
        sc = None
    if sc is None:
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return d.rstrip("/")
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="chartwise-")
        sc.setCheckpointDir(d)  # later calls find it via getCheckpointDir
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works on any URI;
    without a JVM handle (Spark Connect) it asks the file reader instead."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # noqa: BLE001
        from pyspark.errors import AnalysisException
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except AnalysisException:
            return False
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def done_marker(spark: SparkSession, path: str) -> bool:
    """True when a Spark job committed output at ``path`` (its _SUCCESS file)."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def _hadoop(spark: SparkSession, path: str):
    """(jvm, Path, FileSystem) of a path, or None without a JVM handle."""
    try:
        sc = spark.sparkContext
        jvm = sc._jvm
    except Exception:  # noqa: BLE001 - Spark Connect
        return None
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, jpath, jpath.getFileSystem(sc._jsc.hadoopConfiguration())


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` at ``path`` in one step: written beside it, then renamed
    onto it, so a reader finds the old text or the new one, never a part.
    Without a JVM handle Spark's text writer makes a folder of one file."""
    found = _hadoop(spark, path)
    if found is None:
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    jvm, final, fs = found
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    replace_path(spark, beside.toString(), path)


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file onto another, which goes in the same step."""
    jvm, src, fs = _hadoop(spark, source)
    dst = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target))
    src = fs.makeQualified(src)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    kinds = spark.sparkContext._gateway.new_array(rename, 1)
    kinds[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(src, dst, kinds)


def read_small_file(spark: SparkSession, path: str) -> str | None:
    """The text at ``path``, or None if nothing is there."""
    found = _hadoop(spark, path)
    if found is None:
        return "\n".join(r.value for r in spark.read.text(path).collect()) if path_exists(spark, path) else None
    jvm, jpath, fs = found
    if not fs.exists(jpath) or fs.getFileStatus(jpath).isDirectory():
        return None
    stream = fs.open(jpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly in ``path``; none without a JVM handle."""
    found = _hadoop(spark, path)
    if found is None or not found[2].exists(found[1]):
        return []
    return [f.getPath().toString() for f in found[2].listStatus(found[1]) if f.isDirectory()]


def remove_path(spark: SparkSession, path: str) -> None:
    found = _hadoop(spark, path)
    if found is not None:
        found[2].delete(found[1], True)
