"""Result files: tab-separated text with a header.

Writer: NULL is written as an empty field; fields holding a tab, newline or
quote are quoted with doubled quotes, so every value reads back exactly
(only the empty string comes back NULL, as it is written like NULL).

Readers:
  * ``read_result_tsv`` - the exact reader for files this module wrote; a
    record that does not fit the schema is left out of rows and counts alike.
  * ``read_noisy_lines`` - line-oriented reader for files that may carry
    console noise: keep lines holding a tab and not starting with a known
    log prefix, split on tabs, skip lines with too many fields and fill up
    those with too few, drop repeated header rows, coerce numeric columns and
    drop rows whose numeric columns are all unparsable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwise.functions.casts import coerce_numeric
from chartwise.session import path_exists
from chartwise.sources.csv import BAD_RECORD, is_bad, is_good

# Line prefixes treated as console noise, not data.
NOISE_PREFIXES = ("Note ", "WARN ", "INFO ", "SLF4J", "OK", "Time taken",
                  "Logging", "deprecated", "hive>", "WARNING")

# Result columns that are numeric wherever they appear.
NUMERIC_RESULT_COLUMNS = ("num_countries", "total_appearances", "days_on_chart", "best_rank",
                          "total_streams", "peak_streams", "year")

TSV_OPTIONS = {
    "header": "true",
    "sep": "\t",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _checksum(df: DataFrame):
    """A number that depends on all rows and on no order; NULL and ``''`` count
    alike, as they are written alike."""
    values = [F.when(F.col(f"`{f.name}`") != "", F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.coalesce(F.sum(F.xxhash64(*values).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")


def write_result_tsv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> dict:
    """Write a result set. ``single_file`` is only for result sets of bounded
    size (top-k answers, per-year rows); others keep their partitions. Returns
    the manifest, ``rows`` and ``checksum`` of what was written: they are
    observed in the tasks that write, each of which counts once."""
    out = df.coalesce(1) if single_file else df
    seen = Observation()
    out.observe(seen, F.count(F.lit(1)).alias("rows"), _checksum(df).alias("checksum")).write.mode(mode).options(**TSV_OPTIONS).csv(path)
    try:
        return {"rows": seen.get["rows"], "checksum": seen.get["checksum"]}
    except Exception:  # noqa: BLE001 - an empty result whose plan was folded away has nothing to observe
        return {"rows": 0, "checksum": "0"}


def result_facts(results: Mapping[str, DataFrame]) -> DataFrame:
    """(result, rows, checksum) of results as read back, to hold against their
    manifests: a truncated or altered file shows."""
    facts = [df.agg(F.lit(n).alias("result"), F.count(F.lit(1)).alias("rows"), _checksum(df).alias("checksum")) for n, df in results.items()]
    return reduce(DataFrame.unionAll, facts)


def read_result_tsv(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = False,
                    rejects: bool = False) -> DataFrame:
    """Exact reader: names and types are imposed, not inferred. Every column
    is parsed whatever is selected later, so a count is the count of the rows
    that a full read gives. ``rejects=True`` gives the records left out
    instead, as text. With ``missing_ok`` a missing result gives an empty
    frame instead of an error (the caller's gate then reports it)."""
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(BAD_RECORD, T.StringType())]) if rejects else schema)
    full = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType(), True)])
    df = (spark.read.schema(full).options(**TSV_OPTIONS).option("multiLine", "true").option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", BAD_RECORD).option("columnPruning", "false").csv(path))
    if rejects:
        return df.filter(is_bad(*schema.names)).select(BAD_RECORD)
    return df.filter(is_good(*schema.names)).select(*[F.col(f"`{n}`") for n in schema.names])


def is_data_line(c="value", prefixes: Sequence[str] = NOISE_PREFIXES):
    line = F.col(c) if isinstance(c, str) else c
    cond = F.instr(line, "\t") > 0
    for p in prefixes:
        cond = cond & ~F.startswith(line, F.lit(p))
    return cond


def read_noisy_lines(spark: SparkSession, path: str, names: Sequence[str],
                     numeric: Sequence[str] = NUMERIC_RESULT_COLUMNS,
                     prefixes: Sequence[str] = NOISE_PREFIXES) -> DataFrame:
    """Line-level reader (no quoting): see module docstring. A line with more
    fields than names is skipped, one with fewer gets NULLs; numeric columns
    become DOUBLE."""
    lines = spark.read.text(path)
    kept = lines.filter(is_data_line("value", prefixes)).select(F.split("value", "\t", -1).alias("parts"))
    kept = kept.filter(F.size("parts") <= len(names))
    df = kept.select(*[F.get("parts", F.lit(i)).alias(n) for i, n in enumerate(names)])
    df = df.filter(F.col(names[0]).isNull() | (F.col(names[0]) != F.lit(names[0])))
    num = [n for n in names if n in set(numeric)]
    if num:
        df = df.withColumns({n: coerce_numeric(n) for n in num})
        df = df.dropna(how="all", subset=num)
    return df
