"""Raw chart rows derived from the TPC-H-style test tables.

One raw row per lineitem, every column text, with deliberate defects (bad
dates, dates with a time of day, regions padded with blanks or other white space, another chart kind, out-of-range ranks,
missing titles and streams, decimal stream text) so that each cleaning rule
has rows to act on. The same expressions appear in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwise.schema import IngestConfig, Market, RAW_COLUMNS

# The five ASIA nations stand in for the five chart markets
# (matched name, code, display name, display order).
FIXTURE_MARKETS = (
    Market("nation_7", "VN", "Vietnam", 1),
    Market("nation_12", "KR", "Korea", 2),
    Market("nation_2", "JP", "Japan", 3),
    Market("nation_17", "TW", "Taiwan", 4),
    Market("nation_22", "HK", "Hong Kong", 5),
)
# Order dates span 1995-2001; ingest keeps 1996-2000.
FIXTURE_CONFIG = IngestConfig(chart="top200", year_from=1996, year_to=2000, markets=FIXTURE_MARKETS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                                 "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # orders + customer + nation first (the smaller fact side), then the
    # line items, then part. Spark picks each join strategy from sizes.
    buyer = (orders.join(cust, orders.o_custkey == cust.c_custkey)
             .join(nation, F.col("c_nationkey") == nation.n_nationkey)
             .select("o_orderkey", "o_orderstatus", "o_orderdate", "n_name"))
    j = li.join(buyer, li.l_orderkey == buyer.o_orderkey).join(part, F.col("l_partkey") == part.p_partkey)

    c = F.col
    day = c("o_orderdate").cast("date").cast("string")
    cols = {
        "date": F.when(c("l_orderkey") % 97 == 0, F.lit("not-a-date"))
        .when(c("l_orderkey") % 89 == 0, F.concat(day, F.lit(" 00:00:00")))
        .when(c("l_orderkey") % 83 == 0, F.concat(day, F.lit("T12:30:00")))
        .when(c("l_orderkey") % 79 == 0, F.concat(day, F.lit(" ")))
        .otherwise(day),
        "region": F.when(c("o_orderkey") % 3 == 0, F.concat(F.lit(" "), F.upper(c("n_name")), F.lit(" ")))
        .when(c("o_orderkey") % 5 == 0, F.concat(F.lit("\xa0"), c("n_name"), F.lit("\u3000")))
        .otherwise(c("n_name")),
        "chart": F.when(c("o_orderstatus") == "P", F.lit("viral50")).otherwise(F.lit("top200")),
        "trend": F.when(c("l_returnflag") == "A", F.lit("MOVE_UP"))
        .when(c("l_returnflag") == "R", F.lit("MOVE_DOWN")).otherwise(F.lit("NEW_ENTRY")),
        "rank": (F.lit(1) + (c("l_orderkey") * 7 + c("l_linenumber") * 31) % 210).cast("string"),
        "title": F.when(c("l_partkey") % 50 == 0, F.lit(None).cast("string")).otherwise(c("p_name")),
        "artist": c("p_brand"),
        "streams": F.when(c("l_linenumber") == 7, F.lit(None).cast("string"))
        .when(c("l_linenumber") == 6, F.lit("0.0")).otherwise(c("l_quantity").cast("string")),
        "url": F.concat(F.lit("https://example.com/track/"), c("p_partkey").cast("string")),
    }
    return j.select(*[cols[n].alias(n) for n in RAW_COLUMNS])
