"""Connected components by star contraction, in DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwise.llm.common import materialise

MAX_ROUNDS = 60


def _smallest(pairs: DataFrame) -> DataFrame:
    """For each u the smallest of itself and its neighbours v. The minimum is
    taken before the shuffle, so a node with very many links costs no more."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_smallest(both), "u").filter(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _smallest(down)
    linked = down.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionAll(low.filter(F.col("u") != F.col("m")).select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                           F.sum((F.col("u") < F.col("v")).cast("int"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) -> (node, component), component being the
    smallest node reachable. Each round is written to the shared folder.
    Nodes without an edge to another node are not returned."""
    edges = materialise(edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
                        .filter(F.col("u") != F.col("v"))
                        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    if state[0]:
        for _ in range(MAX_ROUNDS):
            edges = materialise(_small_star(_large_star(edges)), "links")
            after = _state(edges)
            if after == state:
                break
            state = after
        else:
            raise RuntimeError("components did not settle")
    # every node now hangs on its component's smallest one
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
