"""Sharding by Karmarkar-Karp differencing.

A partial partition is a tuple of shard loads. Differencing takes the two
partial partitions of largest spread and adds them in opposite order, largest
load to smallest, until one is left. Equal texts form one group, which is
never split between shards.

The method is spread over a cluster in two levels. Heavy groups, those that a
block could not even out, are differenced first, on the driver: by their
definition there are at most ``shards * HEAVY`` of them. The others are dealt into
blocks by a hash of their key, and a task differences each block's groups
together with one more partial partition, the block's share of the heavy
loads; so every block fills up what the heavy groups left uneven, and the place of
the heavy loads says which shard is which. The number of blocks grows with
the number of groups: a task holds about ``block_groups`` of them, whatever
the input. Rows never travel to a group's task: sizes are summed before the
shuffle, and rows then join their group's shard, so a group with a third of all
rows is one row among the heavy.

Places within a shard come from prefix sums: rows are dealt by a hash of their
id into row blocks, counted by (row block, shard), and numbered within these.

Defined cases: a null text counts no bytes and is in the group of empty texts.
Repeated rows are in one group; rows of one id and text take places in any
order, being equal. Rows without an id are placed like any other. Extra
columns are ignored, an empty table gives no rows. With one group for
everything, one shard holds all.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartwise.llm.common import id_and_text, materialise, to_batches

ROW_BYTES = 16
BLOCK_GROUPS = 20_000
BLOCK_ROWS = 100_000
#: A group is heavy if it is larger than a shard's size over four times the number of blocks, or over this.
HEAVY = 2000


def difference(tuples: list[np.ndarray]) -> list[np.ndarray]:
    """Karmarkar-Karp over partial partitions of equal width. Returns for each
    tuple the shard of each of its places."""
    if not tuples:
        return []
    width = len(tuples[0])
    # (-spread, number, loads in falling order, members): member lists (tuple, place) by place
    heap = []
    for k, loads in enumerate(tuples):
        order = np.argsort(-loads, kind="stable")
        heap.append((-int(loads[order[0]] - loads[order[-1]]), k, loads[order], ("leaf", k, order)))
    heapq.heapify(heap)
    number = len(tuples)
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        loads = a + b[::-1]
        order = np.argsort(-loads, kind="stable")
        loads = loads[order]
        heapq.heappush(heap, (-int(loads[0] - loads[-1]), number, loads, ("sum", (left, right), order)))
        number += 1
    # walk down: which shard each place of a node ended in
    out: list = [None] * len(tuples)
    todo = [(heap[0][3], np.arange(width))]
    while todo:
        (kind, what, order), shard = todo.pop()
        placed = np.empty(width, np.int64)
        placed[order] = shard  # place before sorting -> shard
        if kind == "leaf":
            out[what] = placed
        else:
            todo += [(what[0], placed), (what[1], placed[::-1])]
    return out


def single_places(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Karmarkar-Karp over single sizes: the shard of each."""
    loads = np.zeros((len(sizes), shards), np.int64)
    loads[:, 0] = sizes
    return np.array([p[0] for p in difference(list(loads))], np.int64)


def _in_blocks(groups: DataFrame, shards: int, share: np.ndarray) -> DataFrame:
    """groups (block, key, size) -> key, shard. ``share`` is what each shard
    already holds, over the number of blocks."""
    schema = pa.schema([("key", pa.binary()), ("shard", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(held: list[tuple]):
            loads = np.zeros((len(held) + 1, shards), np.int64)
            loads[0] = share
            loads[1:, 0] = [size for _, size in held]
            places = difference(list(loads))
            shard_at = np.argsort(places[0])  # where the shards' own loads ended up
            for (key, _), place in zip(held, places[1:], strict=True):
                yield key, int(shard_at[place[0]])

        def rows():
            at, held = None, []
            for b in batches:
                for block, key, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if block != at and held:
                        yield from solved(held)
                        held = []
                    at = block
                    held.append((key, size))
            if held:
                yield from solved(held)
        return to_batches(rows(), schema)

    # larger groups first within a block, equal ones by key: the same result however rows lie
    return groups.repartition("block").sortWithinPartitions("block", F.desc("size"), "key").mapInArrow(run, "key binary, shard int")


def balance(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
            row_bytes: int = ROW_BYTES, block_groups: int = BLOCK_GROUPS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): byte-balanced shards, with
    gapless places from 0 in each."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = F.encode(text, "UTF-8")
    rows = materialise(id_and_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.unhex(F.sha2(raw, 256)).alias("key")), "shard-rows")
    groups = materialise(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "shard-groups")
    n_groups, n_rows, total = groups.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    blocks = max(1, -(-n_groups // block_groups))
    parts = shards * min(4 * blocks, HEAVY)
    is_heavy = F.col("size") * F.lit(parts) >= F.lit(total)
    heavy = sorted((-r["size"], bytes(r.key)) for r in groups.filter(is_heavy).select("key", "size").collect())  # at most ``parts``
    sizes = np.array([-s for s, _ in heavy], np.int64)
    shard_of = single_places(sizes, shards)
    loads = np.bincount(shard_of, sizes, shards).astype(np.int64) if heavy else np.zeros(shards, np.int64)
    first = spark.createDataFrame([(bytearray(k), int(s)) for (_, k), s in zip(heavy, shard_of, strict=True)], "key binary, shard int")
    rest = groups.filter(~is_heavy).select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), "key", "size")
    where = materialise(_in_blocks(rest, shards, loads // blocks).unionByName(first), "shard-places")
    row_blocks = max(1, -(-n_rows // block_rows))
    out = materialise(rows.join(where, "key").select(
        "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(row_blocks)).alias("row_block")), "shard-members")
    counts = out.groupBy("shard", "row_block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("row_block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "row_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "row_block").orderBy("doc_id", "text_crc32", "size")
    return out.withColumn("at", F.row_number().over(inside) - 1).join(base, ["shard", "row_block"]) \
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("at")).cast("long").alias("slot"))
