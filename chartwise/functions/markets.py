"""The market dimension: lookups as literal maps or a relation.

A list of up to ``MAX_MARKETS`` is marked for broadcast in joins; a longer one
is joined as Spark sees fit. The literal maps are for short lists: a lookup
goes through the entries one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwise.functions.text import strip_ws
from chartwise.schema import MAX_MARKETS, Market


def small(dim: DataFrame, markets: Sequence[Market]) -> DataFrame:
    """``dim``, marked for broadcast if the list is short enough."""
    return F.broadcast(dim) if len(markets) <= MAX_MARKETS else dim


def market_key(c="region") -> Column:
    """Match key of a raw region: whitespace-stripped and lower-cased."""
    return F.lower(strip_ws(c))


def markets_frame(spark: SparkSession, markets: Sequence[Market]) -> DataFrame:
    """The dimension as a literal relation built in the JVM (no Python
    workers are started to serve it)."""
    rows = [F.struct(F.lit(m.key).alias("market_key"), F.lit(m.code).alias("code"),
                     F.lit(m.display).alias("display"), F.lit(m.ordinal).cast("int").alias("ordinal"))
            for m in markets]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _literal_map(pairs) -> Column:
    flat = []
    for k, v in pairs:
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)


def market_code(c="region", markets: Sequence[Market] = ()) -> Column:
    """Known market name -> code; any other value passes through unchanged."""
    raw = F.col(c) if isinstance(c, str) else c
    code = F.try_element_at(_literal_map((m.key, m.code) for m in markets), market_key(raw))
    return F.coalesce(code, raw)


def display_name(c="region", markets: Sequence[Market] = ()) -> Column:
    """Code -> display name, falling back to the code itself."""
    raw = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_element_at(_literal_map((m.code, m.display) for m in markets), raw), raw)
