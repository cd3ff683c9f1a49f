"""Clean charts at rest: Parquet files plus an external catalog table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from chartwise.schema import CHART_COLUMNS, CHART_COMMENTS, CHARTS_SCHEMA

DEFAULT_PARTITIONS = ("region", "year")


#: Equal shares that a sketch cuts a hot folder's rows into, and the most folders that are cut.
SHARES, MOST_HOT = 64, 10_000


def hot_folders(df: DataFrame, partition_by: Sequence[str], cut_rows: int) -> DataFrame:
    """(keys, pieces, cuts): the folders that will hold more than ``cut_rows``
    rows, into how many pieces of about so many they go, and the places (by date
    and rank) that cut their rows into ``SHARES`` equal shares, by a quantile
    sketch. At most ``MOST_HOT`` folders: if need be ``cut_rows`` grows."""
    per = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(_place(), [k / SHARES for k in range(1, SHARES)], 100 * SHARES).alias("cuts"))
    total = Window.partitionBy(F.lit(1))  # over one row per folder
    least = F.greatest(F.lit(cut_rows), F.floor(F.sum("n").over(total) / MOST_HOT))
    return per.withColumn("least", least).filter(F.col("n") > F.col("least")) \
        .select(*partition_by, F.least(F.ceil(F.col("n") / F.col("least")), F.lit(SHARES)).cast("int").alias("pieces"), "cuts")


def _place():
    return F.coalesce(F.unix_date("date"), F.lit(0)).cast("bigint") * 100_000 + F.coalesce("rank", F.lit(0))


def _pieces(df: DataFrame, partition_by: Sequence[str], cut_rows: int) -> DataFrame:
    """``df`` with the piece of its folder that each row goes to: 0, or by its
    place among the cuts of a hot folder."""
    hot = hot_folders(df, partition_by, cut_rows).withColumnsRenamed({k: f"_hot_{k}" for k in partition_by})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in partition_by])
    share = F.size(F.filter("cuts", lambda c: c < _place()))
    piece = F.coalesce(F.floor(share * F.col("pieces") / SHARES).cast("int"), F.lit(0))
    return df.join(F.broadcast(hot), same, "left").select(*df.columns, piece.alias("_piece"))  # hot: at most MOST_HOT rows


def write_charts(df: DataFrame, path: str, partition_by: Sequence[str] = DEFAULT_PARTITIONS,
                 mode: str = "overwrite", compression: str = "snappy",
                 observation: Observation | None = None, cut_rows: int | None = None) -> None:
    """Write clean charts as Parquet, partitioned by market and year.

    Partition folders let a one-market question read one market only.
    ``rebalance`` on the partition keys gives each (market, year) one task
    and so few, large files; AQE splits any partition above the advisory
    size (a market holding most rows) into several tasks at run time and
    merges small ones - without the extra sampling read a range repartition
    would cost. Each task sorts by (keys, date, rank): files come out
    ordered by date, which tightens Parquet min/max statistics for date
    predicates, and the sort already satisfies the writer's own ordering on
    the partition keys. ``observation`` counts written rows once.

    AQE can split such a partition only between the outputs of map tasks: an
    input read by a few tasks (compressed files) leaves a hot folder to as few.
    ``cut_rows`` cuts folders of more rows by date into pieces of about so many,
    each a key of its own, for one more scan of the folder keys, date and rank.
    """
    out = df
    if partition_by and cut_rows:
        out = _pieces(df, partition_by, cut_rows).hint("rebalance", *partition_by, "_piece").sortWithinPartitions(*partition_by, "date", "rank").drop("_piece")
    elif partition_by:
        out = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, "date", "rank")
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    w = out.write.mode(mode).option("compression", compression)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def read_charts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHARTS_SCHEMA).parquet(path).select(*CHART_COLUMNS)


def read_codecs(spark: SparkSession, path: str) -> DataFrame:
    """(file, codec, rows): each Parquet file below ``path`` with the codec of
    its first column, from its footer; files are looked at in parallel."""
    import io

    import pyarrow.parquet as pq

    def footers(batches):
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                meta = pq.ParquetFile(io.BytesIO(content.as_py())).metadata
                codecs = {meta.row_group(g).column(0).compression for g in range(meta.num_row_groups)}
                yield pa.RecordBatch.from_arrays([pa.array([file.as_py()]), pa.array([",".join(sorted(codecs))]), pa.array([meta.num_rows], pa.int64())], names=["file", "codec", "rows"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "content").mapInArrow(footers, "file string, codec string, rows long")


def _ddl_columns(partition_by: Sequence[str]) -> str:
    fields = [f for f in CHARTS_SCHEMA.fields if f.name not in partition_by] + \
             [f for f in CHARTS_SCHEMA.fields if f.name in partition_by]
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()} COMMENT '{CHART_COMMENTS[f.name]}'"
                        for f in fields)


def register_table(spark: SparkSession, path: str, db: str, name: str,
                   partition_by: Sequence[str] = DEFAULT_PARTITIONS, require_rows: bool = True) -> DataFrame:
    """Create (or replace) an external Parquet table over ``path``.

    Dropping the old definition leaves its files in place (external table).
    Returns the table, reordered to the chart column order. With
    ``require_rows`` an empty table is an error (checked with a LIMIT 1 scan,
    not a full count).
    """
    qualified = f"`{db}`.`{name}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    spark.sql(f"DROP TABLE IF EXISTS {qualified}")
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"""
        CREATE TABLE {qualified} (
          {_ddl_columns(partition_by)}
        )
        USING PARQUET
        {parts}
        LOCATION '{escaped}'
        TBLPROPERTIES ('parquet.compression'='SNAPPY')
    """)
    if partition_by:
        spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
    t = spark.table(qualified).select(*CHART_COLUMNS)
    if require_rows and t.isEmpty():
        raise RuntimeError(f"no row in {db}.{name} (0 rows): nothing was written to {path}, or not as Parquet")
    return t


def use_database(spark: SparkSession, db: str) -> None:
    spark.catalog.setCurrentDatabase(db)
