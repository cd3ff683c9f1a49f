"""Ranked lexical search over bit-sliced Bloom signatures.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z
lower-cased. A document's score for a query is the sum over the query's terms,
repeats included, of ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with ``w =
floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 25 + (75 * n * N) div
L`` (N: documents with a term, L: their terms, n: the document's terms, df:
documents with the term, tf: its occurrences).

* *Index.* Documents lie in batches, one table row each. Within a batch they
  are grouped by size, and each group has a Bloom signature in slices: bit
  ``i`` of all its documents is one bitmap. A term sets ``HASHES`` bits; one
  that occurs 2, 4, 8 or 16 times or more sets bits for each of these as well.
* *Bounds.* The intersection of a term's slices marks every document that has
  it, and some that have not. Slices weighted by ``w`` and summed, level by
  level, times what the document's length allows a term of that level, bound
  the score from above.
* *Scores.* Documents are scored exactly, from their texts, in falling order of
  bounds, until no other can enter the best ``k`` of its task; the tasks' best
  are ranked together.

``N``, ``L`` and the ``df`` of the queries' terms are exact counts over all
documents. Queries are taken in blocks of at most ``block_bytes`` of text (a
longer one is a block of its own), whose terms are broadcast; each block is one
scan over the index. No document moves: only the best of each task do.

Defined cases: null and blank texts have no terms and are never found; null
and blank queries find nothing. Rows that share an id are ranked one by one; a
null id comes after all others. Queries of equal id and text count once, rows
of one id with other texts are queries of their own. Empty tables give no rows.
Texts of any length are scored whole. Ties go by ascending id.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwise.llm.common import Recent, id_and_text, materialise, to_batches
from chartwise.llm.decontaminate import folded
from chartwise.llm.substrings import BATCH_BYTES, LAST, open_batch, pack_batches

#: Text of the queries of one scan, and documents whose bounds are worked out together.
BLOCK_BYTES, AT_ONCE = 1 << 20, 512
#: Bits of a signature for each entry, bits that an entry sets, and the counts from which a term has further entries.
BITS, HASHES, LEVELS = 12, 4, (1, 2, 4, 8, 16)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_GROUP = pa.struct([("rows", pa.binary()), ("slices", pa.int64()), ("bits", pa.binary())])
_INDEX = pa.schema([("b", pa.int64()), ("payload", pa.binary()), ("docs", pa.int64()), ("terms", pa.int64()), ("lengths", pa.binary()), ("groups", pa.list_(_GROUP))])
_INDEX_DDL = "b long, payload binary, docs long, terms long, lengths binary, groups array<struct<rows:binary,slices:long,bits:binary>>"


def terms(text: str | None) -> list[bytes]:
    return folded(text).split()


def entries(hashes: np.ndarray, level: int) -> np.ndarray:
    """The hashes of the entries of terms that occur LEVELS[level] times."""
    return (hashes ^ np.uint64(level)) * _ODD[0]


def slices_of(entry: np.ndarray, slices: int) -> np.ndarray:
    """The slices that each entry sets: one row per hash function."""
    return ((entry[None, :] * _ODD[:HASHES, None]) >> np.uint64(24)) % np.uint64(slices)


def signature(own: list[np.ndarray], slices: int) -> np.ndarray:
    """Slices of a group of documents, given each one's entries: row ``i`` has
    bit ``i`` of every document, eight to a byte."""
    bits = np.zeros((slices, -(-len(own) // 8) * 8), np.uint8)
    doc = np.repeat(np.arange(len(own)), [len(x) for x in own])
    for at in slices_of(np.concatenate(own), slices):
        bits[at, doc] = 1
    return np.packbits(bits, axis=1)


def present(bits: np.ndarray, entry: np.ndarray, docs: int) -> np.ndarray:
    """For each entry, which documents may have it (0 or 1)."""
    rows = slices_of(entry, len(bits))
    return np.unpackbits(reduce(np.bitwise_and, (bits[r] for r in rows)), axis=1)[:, :docs]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The index, materialised: one row per batch of documents."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Recent(xxhash.xxh3_64_intdigest)
        for batch in batches:
            for i in range(batch.num_rows):
                lengths, own = [], {}
                for r, text in enumerate(open_batch(batch.column("payload")[i]).column(1)):
                    words = terms(text.as_py())
                    lengths.append(len(words))
                    if words:
                        count = Counter(words)
                        h = np.fromiter(map(cache.__getitem__, count), np.uint64, len(count))
                        tf = np.fromiter(count.values(), np.int64, len(count))
                        mine = np.concatenate([entries(h[tf >= least], k) for k, least in enumerate(LEVELS)])
                        own.setdefault(len(mine).bit_length(), []).append((r, mine))
                groups = [{"rows": np.array([r for r, _ in g], np.int32).tobytes(), "slices": BITS << size,
                           "bits": signature([x for _, x in g], BITS << size).tobytes()} for size, g in sorted(own.items())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in zip((batch.column("b")[i].as_py(), batch.column("payload")[i].as_py(), sum(map(bool, lengths)), sum(lengths),
                                                       np.array(lengths, np.int64).tobytes(), groups), _INDEX.types, strict=True)], schema=_INDEX)

    return materialise(pack_batches(id_and_text(docs, id_col, text_col), batch_bytes).mapInArrow(run, _INDEX_DDL), "search-index")


def _document_counts(index: DataFrame, known: dict[bytes, int]) -> list[int]:
    """In how many documents each of the known terms is."""
    shared = index.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for payload in batch.column(0):
                for text in open_batch(payload).column(1):
                    found.update(shared.value.keys() & set(terms(text.as_py())))
        yield from to_batches(((shared.value[t], c) for t, c in found.items()), pa.schema([("t", pa.int32()), ("c", pa.int64())]))

    df = [0] * len(known)
    for r in index.select("payload").mapInArrow(run, "t int, c long").groupBy("t").agg(F.sum("c").alias("c")).collect():
        df[r.t] = r.c
    return df


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 25 + (75 * n * n_docs) // n_terms


def saturation(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Best:
    """The best k documents of each query so far, as far as one task knows."""

    def __init__(self, known: dict, k: int):
        self.known, self.k = known, k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in known["queries"]]

    def add(self, ids: np.ndarray, texts, lengths: np.ndarray, groups: list[dict]) -> None:
        known = self.known
        counted: dict[int, dict[int, int]] = {}

        def parts(r: int, m: int) -> dict[int, int]:
            if r not in counted:
                number = known["terms"]
                count = Counter(number[t] for t in terms(texts[r].as_py()) if t in number)
                counted[r] = {t: saturation(tf, m) for t, tf in count.items()}
            return counted[r]

        for all_rows, all_bits, at in ((np.frombuffer(g["rows"], np.int32), np.frombuffer(g["bits"], np.uint8).reshape(g["slices"], -1), at)
                                       for g in groups for at in range(0, len(g["rows"]) // 4, AT_ONCE)):
            rows, bits = all_rows[at:at + AT_ONCE], all_bits[:, at // 8:(at + AT_ONCE) // 8]
            m = [length_norm(int(n), known["docs"], known["all_terms"]) for n in lengths[rows]]
            # the most that a term below the next level, and at last any, can give
            tops = [[saturation(min(int(n), most), x) for n, x in zip(lengths[rows], m, strict=True)] for most in (*(x - 1 for x in LEVELS[1:]), 1 << 40)]
            steps = np.diff(np.array(tops, np.float64), axis=0, prepend=0)
            may = [present(bits, entries(known["hashes"], k), len(rows)) for k in range(len(LEVELS))]
            some = [x.any(1) for x in may]
            for q, (of, weight) in enumerate(known["queries"]):
                bound = np.zeros(len(rows))
                for x, any_, step in zip(may, some, steps, strict=True):
                    on = any_[of]
                    if on.any():
                        bound += (weight[on] @ x[of[on]].astype(np.float64)) * step
                self._score(q, bound, rows, ids, m, parts)

    def _score(self, q: int, bound, rows, ids, m, parts) -> None:
        heap = self.heaps[q]
        least = heap[0][0] if len(heap) == self.k else 1
        maybe = np.flatnonzero(bound >= least)
        for at in maybe[np.argsort(-bound[maybe], kind="stable")].tolist():
            if len(heap) == self.k and bound[at] < heap[0][0]:
                return
            mine = parts(int(rows[at]), m[at])
            score = sum(w * mine[t] for t, w in self.known["exact"][q] if t in mine)
            if score > 0:
                (heapq.heappushpop if len(heap) == self.k else heapq.heappush)(heap, (score, -int(ids[rows[at]])))


def _best_of_tasks(index: DataFrame, known: dict, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(shared.value, k)
        for batch in batches:
            for i in range(batch.num_rows):
                docs = open_batch(batch.column("payload")[i])
                ids = pc.fill_null(docs.column(0), int(LAST)).to_numpy(zero_copy_only=False)
                best.add(ids, docs.column(1), np.frombuffer(batch.column("lengths")[i].as_py(), np.int64), batch.column("groups")[i].as_py())
        yield from to_batches(((q, -d, s) for q, heap in enumerate(best.heaps) for s, d in heap), pa.schema([("q", pa.int32()), ("d", pa.int64()), ("score", pa.int64())]))

    return index.select("payload", "lengths", "groups").mapInArrow(run, "q int, d long, score long")


def _query_blocks(queries: DataFrame, block_bytes: int) -> list[DataFrame]:
    queries = queries.filter(F.col("t").isNotNull()).distinct()
    size = queries.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    return [queries.filter(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == k) for k in range(count)]


def search(index: DataFrame, queries: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, rank, doc_id, score): the ``k`` best documents of each query,
    the item column under its own name and type."""
    spark = index.sparkSession
    wanted = queries.select(F.col(item_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    kind = wanted.schema["i"].dataType
    n_docs, n_terms = (x or 0 for x in index.agg(F.sum("docs"), F.sum("terms")).first())
    out = spark.createDataFrame([], T.StructType([T.StructField("i", kind), T.StructField("d", T.LongType()), T.StructField("score", T.LongType()), T.StructField("rank", T.IntegerType())]))
    for block in _query_blocks(wanted, block_bytes):
        asked = [(r.i, Counter(words)) for r in block.collect() if (words := terms(r.t))]
        if not asked or not n_docs:
            continue
        known = {t: x for x, t in enumerate(dict.fromkeys(t for _, c in asked for t in c))}
        weight = [term_weight(n_docs, x) for x in _document_counts(index, known)]
        exact = [[(known[t], weight[known[t]] * times) for t, times in c.items()] for _, c in asked]
        facts = {"terms": known, "docs": n_docs, "all_terms": n_terms, "exact": exact, "hashes": np.array([xxhash.xxh3_64_intdigest(t) for t in known], np.uint64),
                 "queries": [(np.array([t for t, _ in x]), np.array([w for _, w in x], np.float64)) for x in exact]}
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(asked)], T.StructType([T.StructField("q", T.IntegerType()), T.StructField("i", kind)]))
        best = _ranked(_ranked(_best_of_tasks(index, facts, k).withColumn("task", F.spark_partition_id() % 64), k, "q", "task").drop("rank"), k, "q")
        out = out.unionByName(best.join(F.broadcast(names), "q").select("i", "d", "score", "rank"))
    return out.select(F.col("i").alias(item_col), "rank", F.when(F.col("d") != int(LAST), F.col("d")).alias("doc_id"), "score")


def _ranked(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "d")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
