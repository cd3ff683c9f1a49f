"""Raw chart CSV: all-text read with columns matched by header name, and the
split write by market and month. Quotes inside fields are doubled (``""``),
so the reader escapes with ``"`` as well; files whose headers disagree are
an error, not a silent column swap.

A record that does not fit (too few or too many fields, a quote that is never
closed) is a bad record: it is kept as text in the column ``BAD_RECORD`` with
``bad_records="keep"``, left out with ``"drop"``, or ends the job with ``"fail"``.
Its fields never come through shifted or half empty as if they were data, and
it takes no other record with it.

Spark's reader alone cannot promise that (see ``sources.framing``), so a path is
audited first. If every line is a record, as usual, Spark's reader does the
rest. Otherwise records are put together from lines, in parallel within each
file, and parsed one by one, each by the header of its own file."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwise.functions.text import normalize_name
from chartwise.schema import RAW_SCHEMA
from chartwise.sources.framing import Audit, audit, file_headers, framed_records, scan_lines

#: Column that holds the text of a record that does not fit, else NULL.
BAD_RECORD = "_bad_record"

CSV_READ_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "enforceSchema": "false",  # check every file's header against the schema
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD_RECORD,
    "columnPruning": "false",  # a record is judged by all its fields, whatever a query selects
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_WRITE_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def is_good(*columns: str):
    """Whether a row read with ``BAD_RECORD`` is a good record. The condition
    names columns of the data: at least one, since Spark refuses a query on a
    CSV file that uses nothing but the bad-record column (a count, for
    instance), and every typed one, as only columns in use are converted."""
    return F.col(BAD_RECORD).isNull() & _names(columns)


def is_bad(*columns: str):
    return F.col(BAD_RECORD).isNotNull() & _names(columns)


def _names(columns):
    """Always true, but not known to be so before a row is seen."""
    text = [F.col(f"`{c}`").cast("string") for c in columns]
    return reduce(lambda x, y: x & y, [c.isNull() | (F.length(c) >= 0) for c in text])


def first_data_file(spark: SparkSession, path: str | list[str]) -> str | None:
    """The first data file under ``path`` (a file, a folder or a glob pattern;
    hidden and ``_``-prefixed entries skipped), found with a lazy Hadoop listing that stops at the first hit
    instead of listing the whole tree. Without JVM access (Spark Connect)
    the folder itself is returned and Spark reads the header from its
    first file."""
    if not isinstance(path, str):
        return path[0] if path else None
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # noqa: BLE001 - no driver JVM handle in this client
        return path
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(root) or ():
        if found.isFile():
            return found.getPath().toString()
        if inner := _first_below(fs, found.getPath()):
            return inner
    return None


def _first_below(fs, root) -> str | None:
    it = fs.listFiles(root, True)
    while it.hasNext():
        p = it.next().getPath()
        rel = p.toString()[len(root.toString()):]
        if not any(part.startswith(("_", ".")) for part in rel.split("/") if part):
            return p.toString()
    return None


def raw_header(spark: SparkSession, data_file: str) -> list[str]:
    """Column names from the header line of one file (no type inference)."""
    return spark.read.options(header="true", sep=",", quote='"', escape='"').csv(data_file).columns


def read_raw_csv(spark: SparkSession, path: str | list[str], schema=RAW_SCHEMA, streaming: bool = False,
                 multi_line: bool | None = None, by_name: bool = True, bad_records: str = "drop", audited: bool = True, **options) -> DataFrame:
    """A file, a list of files or a directory of raw chart CSVs (partition
    folders included).

    Columns are matched by header name (after the column-name rule: strip,
    lower-case, blanks to underscores), so files listing the same columns in
    another order read correctly; all values are read as text.
    ``by_name=False`` imposes ``schema`` positionally (header names must then
    match it exactly).

    No type inference: that would be an extra full pass over the input and
    would guess types differently file by file. Files are split into
    ``spark.sql.files.maxPartitionBytes`` chunks and parsed in parallel.

    The path is audited first (see the module's text), which costs one scan of
    its lines: quotes never closed, line breaks in quoted fields and files whose
    headers list the columns in another order are then read right, and a line
    equal to its file's header counts as one wherever it stands. With
    ``multi_line=False`` each line is a record, and one that ends inside a quoted
    field a bad one; the default lets records go over several lines. A stream,
    or a path whose schema is imposed by position, is not audited, nor is one
    with ``audited=False``: then ``multi_line=True`` means Spark's own reader of
    such files, one task per file, and every header must equal the first one
    (``enforceSchema=false``).
    """
    if bad_records not in ("keep", "drop", "fail"):
        raise ValueError("bad_records must be keep, drop or fail")
    if multi_line is None:
        multi_line = not streaming
    reader = spark.readStream if streaming else spark.read
    reader = reader.options(**CSV_READ_OPTIONS).option("multiLine", "true" if multi_line else "false") \
        .options(**options)
    bad_field = T.StructField(BAD_RECORD, T.StringType(), True)

    def judged(df: DataFrame, columns: list) -> DataFrame:
        if bad_records == "keep":
            return df.select(*columns, BAD_RECORD)
        good = is_good(df.columns[0])
        if bad_records == "fail":
            said = F.concat(F.lit("bad record in raw CSV: "), F.substring(BAD_RECORD, 1, 300))
            good = F.when(good, F.lit(True)).otherwise(F.raise_error(said).isNotNull())
        return df.filter(good).select(*columns)

    first = first_data_file(spark, path) if by_name else None
    if first is not None and audited and not streaming and not options:
        found = audit_raw_csv(spark, path, first)
        if not found.clean:
            return _framed(spark, path, schema, found, first, bad_records, multi_line)
        reader = reader.option("multiLine", "false")  # every line is a record
    if first is None:  # positional schema, or no files yet (a stream waiting for input)
        return judged(reader.schema(T.StructType([*schema.fields, bad_field])).csv(path), [f.name for f in schema.fields])
    header = raw_header(spark, first)
    by_norm = {normalize_name(h): h for h in header}
    wanted = [f.name for f in schema.fields]
    # folder keys (``key=value`` directories) are not in the file header
    folder_keys = [c for c in wanted if c not in by_norm and f"/{c}=" in first]
    missing = [c for c in wanted if c not in by_norm and c not in folder_keys]
    if missing:
        raise ValueError(f"raw CSV at {path} lacks columns {missing}; its header is {header}")
    by_norm.update({c: c for c in folder_keys})
    file_schema = T.StructType([*[T.StructField(h, T.StringType(), True) for h in header + folder_keys], bad_field])
    df = reader.schema(file_schema).csv(path)
    return judged(df, [F.col("`" + by_norm[c].replace("`", "``") + "`").alias(c) for c in wanted])


def audit_raw_csv(spark: SparkSession, path: str | list[str], first: str | None = None) -> Audit:
    """What the lines below ``path`` are; see ``sources.framing.audit``."""
    first = first or first_data_file(spark, path)
    if first is None:
        return Audit(0, 0, 0, 0, 0, True, ("",))
    line = spark.read.option("lineSep", "\n").text(first).first()
    return audit(spark, path, (line.value or "").removesuffix("\r") if line else "")


def _framed(spark: SparkSession, path: str | list[str], schema, found: Audit, first: str, bad_records: str, multi_line: bool) -> DataFrame:
    """The records that ``framing`` finds, each parsed by its file's header."""
    wanted = [f.name for f in schema.fields]
    headers = {h: [normalize_name(x) for x in next(csv.reader([h]), [])] for h in found.headers}
    folder_keys = [c for c in wanted if f"/{c}=" in first and not any(c in names for names in headers.values())]
    for header, names in headers.items():
        if missing := [c for c in wanted if c not in names and c not in folder_keys]:
            raise ValueError(f"raw CSV at {path} lacks columns {missing} in files whose header is {header}")
    records = framed_records(spark, path, folder_keys, any_open=multi_line and found.open_lines > 0)
    own = F.lit(found.headers[0])
    if len(headers) > 1:
        records = records.join(file_headers(scan_lines(spark, path)).withColumnRenamed("file", "f"), F.col("file") == F.col("f"))
        own = F.col("header")
    options = {k: v for k, v in CSV_READ_OPTIONS.items() if k not in ("header", "enforceSchema", "columnPruning")}
    parsed = F.lit(None)
    for header, names in headers.items():
        fields = [names.index(c) for c in wanted if c not in folder_keys]
        text = F.from_csv("record", ", ".join([*(f"_{i} string" for i in range(len(names))), f"`{BAD_RECORD}` string"]), options)
        one = F.struct(*[text[f"_{i}"].alias(f"_{k}") for k, i in enumerate(fields)], text[BAD_RECORD].alias(BAD_RECORD))
        parsed = F.when(own == F.lit(header), one).otherwise(parsed)
    rows = records.filter(F.col("record") != own).select(parsed.alias("x"), "record", "fits", *folder_keys)
    bad = F.when(~F.col("fits") | F.col(f"x.{BAD_RECORD}").isNotNull(), F.col("record"))
    places = iter(range(len(wanted)))
    rows = rows.select(*[F.col(c) if c in folder_keys else F.col(f"x._{next(places)}").alias(c) for c in wanted], bad.alias(BAD_RECORD))
    if bad_records == "keep":
        return rows
    good = F.col(BAD_RECORD).isNull()
    if bad_records == "fail":
        said = F.concat(F.lit("bad record in raw CSV: "), F.substring(BAD_RECORD, 1, 300))
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(said).isNotNull())
    return rows.filter(good).select(*wanted)


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def write_split_csv(df: DataFrame, path: str, keys=("country_code", "month_str"), mode: str = "overwrite",
                    observation: Observation | None = None) -> None:
    """One folder per (market, month), like the per-country-month split files.

    ``rebalance`` on the split keys sends each (market, month) to one task,
    so each folder normally gets one file; at run time AQE splits a
    partition that outgrows the advisory size (a hot market or month) into
    several and merges small ones. Unlike a range repartition this needs no
    sampling job, i.e. no second read of the input. ``observation`` counts
    the written rows (it sits above the exchange).
    """
    out = df.hint("rebalance", *keys).sortWithinPartitions(*keys, "date", "rank")
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    out.write.mode(mode).partitionBy(*keys).options(**CSV_WRITE_OPTIONS).csv(path)


def read_split_csv(spark: SparkSession, path: str, keys=("country_code", "month_str"),
                   streaming: bool = False, multi_line: bool = True, **options) -> DataFrame:
    """Split folders back as raw rows. The folder keys are declared as text so
    that partition discovery does not guess a type for them (``1996-01``).
    Files written here may hold line breaks in quoted fields, so a file is
    read whole by default; the writer keeps files to a task's size and closes
    every quote, so they are not audited."""
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(k, T.StringType(), True) for k in keys])
    return read_raw_csv(spark, path, schema=schema, streaming=streaming, multi_line=multi_line, audited=False, **options)


def drop_helpers(df: DataFrame, *cols: str) -> DataFrame:
    """Drop helper columns, ignoring any that are absent."""
    return df.drop(*cols)
