"""Exact substring dedup: seed and extend over winnowed anchors.

Words are the runs between ASCII white space, unchanged. A repeat is a run of
at least ``n`` words that a document of smaller id holds as well; words within
a repeat go. Method:

* *Seeds.* Of every ``n - k + 1`` neighbouring k-word grams the one with the
  smallest hash is an anchor, so each window of ``n`` words holds the anchor
  that its own words choose, and equal windows choose equal anchors.
* *Join.* Documents are joined on their anchors. Anchors of one place go no
  further.
* *Extend.* A shared anchor is extended both ways, a word at a time, to every
  window of ``n`` words that chose it; of equal windows (96 bits of hash) the
  smallest document keeps its own. Neighbouring repeated windows of a document
  together are its maximal repeats.

Documents are packed, as they come, into batches of about ``batch_bytes``, one
table row each, in a bucketed table, so batches never move again. A batch sends
each distinct anchor, later each distinct window of shared anchors with its
smallest document, once, as sorted delta-coded numbers dealt by hash range; it
hears back which of them occur elsewhere, or in a smaller document. So a
passage that a third of all documents hold costs one entry per batch, and no
task's share depends on how often anything repeats. Messages and batches are
materialised in the shared folder; nothing is collected.

Defined cases: null and blank texts have no words; texts of fewer than ``n``
words lose nothing. A null id counts as larger than every id. Rows of one id
take nothing from each other; repeated rows fare alike. Empty tables give empty
results. A text of any length is one batch at most. Other columns are kept,
whatever their names; those with the names of the results are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwise.llm.common import materialise
from chartwise.llm.words import Alphabet, Words, words_of
from chartwise.session import scratch_path

BATCH_BYTES, RANGE_BYTES, BUCKET_BYTES = 4 << 20, 48 << 20, 32 << 20
LAST = np.iinfo(np.int64).max
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Anchors are compared by their leading 48 bits; a chance match costs a look, no more.
CUT = np.uint64(16)
WORDS = Alphabet(b"\x20\t\n\v\f\r")
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))


def pack_ints(v: np.ndarray) -> bytes:
    """64-bit numbers as their least, a width, and the rest in that width."""
    if not len(v):
        return b""
    base = v.min()
    rest = (v - base).view(np.uint64)
    width = max(1, (int(rest.max()).bit_length() + 7) // 8)
    return base.tobytes() + bytes([width]) + rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_ints(raw: bytes, kind=np.uint64) -> np.ndarray:
    if not raw:
        return np.zeros(0, kind)
    width = raw[8]
    planes = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    rest = np.zeros((len(planes), 8), np.uint8)
    rest[:, :width] = planes
    return rest.view("<u8").ravel().view(kind) + np.frombuffer(raw, kind, 1)


def pack_sorted(v: np.ndarray) -> bytes:
    return v[:1].tobytes() + pack_ints(np.diff(v)) if len(v) else b""


def unpack_sorted(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(raw, np.uint64, 1), unpack_ints(raw[8:])]), dtype=np.uint64)


def grams(h: np.ndarray, k: int, by: np.uint64 = _M1) -> np.ndarray:
    """Hashes of all runs of k words, from the words' hashes."""
    out = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k if len(out) else 0):
        out = (out + h[j:j + len(out)]) * by
        out ^= out >> np.uint64(29)
    return out


def least_of(v: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every ``size`` neighbours."""
    span = 1
    while 2 * span <= size:
        v, span = np.minimum(v[:len(v) - span], v[span:]), 2 * span
    return np.minimum(v[:len(v) - (size - span)], v[size - span:]) if size > span else v


def windows_of(words: Words, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of all windows of n words within one text, and the anchors
    that they choose; and which of them begin a run of one choice."""
    if len(words.hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    anchors = least_of(grams(words.hashes, k), n - k + 1)
    at = np.flatnonzero(words.row[n - 1:] == words.row[:len(words.row) - n + 1])
    anchors, row = anchors[at], words.row[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
    return at, anchors, new


def dealt(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """The hash ranges that sorted keys fall into."""
    q = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    cuts = np.concatenate([np.flatnonzero(np.diff(q, prepend=q[:1] + np.uint64(1))), [len(q)]]) if len(q) else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(q[a]), slice(int(a), int(b))


def open_batch(payload) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload.as_buffer()) as r:
        return r.read_next_batch()


def pack_batches(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``docs`` (id, text first) -> (b: long, payload: binary): documents as
    compressed record batches of bounded size, each under its own number."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId() << 32
        held, size, seq = [], 0, 0

        def done():
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                for part in whole:
                    w.write_batch(part)
            return pa.RecordBatch.from_arrays([pa.array([own + seq], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["b", "payload"])

        for batch in batches:
            first = 0
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for i, length in enumerate(lengths):
                size += length + 64
                if size >= batch_bytes:
                    held.append(batch.slice(first, i + 1 - first))
                    yield done()
                    held, size, seq, first = [], 0, seq + 1, i + 1
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield done()

    return docs.mapInArrow(run, "b long, payload binary")


@contextmanager
def batch_table(docs: DataFrame, batch_bytes: int, buckets: int) -> Iterator[DataFrame]:
    """The batches of ``docs`` as a table bucketed by their number, so that
    answers come to where they lie; the table's name goes at the end."""
    spark = docs.sparkSession
    name = f"batches_{uuid.uuid4().hex}"
    pack_batches(docs, batch_bytes).write.bucketBy(buckets, "b").option("path", scratch_path(spark, "batches")).format("parquet").saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def parts_of(docs: DataFrame, range_bytes: int) -> tuple[int, int]:
    """Numbers of hash ranges and of buckets, from the size of the texts."""
    size = docs.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    spark = docs.sparkSession
    wide = [spark.conf.get(f"spark.sql.{x}", "1") for x in ("shuffle.partitions", "adaptive.coalescePartitions.initialPartitionNum")]
    return max(1, -(-size // range_bytes)), max(2 * spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES), *map(int, wide))


def heard(batch: pa.RecordBatch, column: str, i: int) -> list[bytes]:
    return batch.column(column)[i].as_py() or []


def _shared(docs: pa.RecordBatch, elsewhere: np.ndarray, n: int, k: int):
    """The windows of a batch that hold a shared anchor: (w1, w2, id, place)
    in order of (w1, w2, id), the smallest id of each, and the words."""
    words = words_of(docs.column(1), WORDS)
    ids = pc.fill_null(docs.column(0), int(LAST)).to_numpy(zero_copy_only=False).astype(np.int64)
    at, chosen, new = windows_of(words, n, k)
    order = np.argsort(chosen[new], kind="stable")
    a, row = chosen[new][order], words.row[at[new]][order]
    twice = a[1:][(a[1:] == a[:-1]) & (row[1:] != row[:-1])]
    known = np.unique(np.concatenate([twice >> CUT, elsewhere]))
    at = at[member(chosen >> CUT, known)]
    w1, w2, doc = grams(words.hashes, n)[at], grams(words.hashes, n, _M2)[at] >> np.uint64(32), ids[words.row[at]]
    order = np.lexsort((doc, w2, w1))
    w1, w2, doc, at = w1[order], w2[order], doc[order], at[order]
    return w1, w2, doc, at, doc[_heads(w1, w2)], words


def _heads(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    """For each entry of sorted pairs the index of the first equal one."""
    new = np.ones(len(w1), bool)
    new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
    if not len(w1):
        return np.zeros(0, np.int64)
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def member(v: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``v`` are among the sorted ``known``."""
    if not len(known):
        return np.zeros(len(v), bool)
    return known[np.minimum(np.searchsorted(known, v), len(known) - 1)] == v


MESSAGE = pa.schema([("q", pa.int32()), ("b", pa.int64()), ("keys", pa.binary()), ("checks", pa.binary()), ("ids", pa.binary())])
MESSAGE_DDL = "q int, b long, keys binary, checks binary, ids binary"


def messages(rows: list) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + 64], strict=True), MESSAGE.types, strict=True)], schema=MESSAGE)


def _seed_messages(n: int, k: int, ranges: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, chosen, new = windows_of(words_of(open_batch(batch.column("payload")[i]).column(1), WORDS), n, k)
                keys = np.unique(chosen[new] >> CUT)
                b = batch.column("b")[i].as_py()
                yield from messages([(q, b, pack_sorted(keys[s]), b"", b"") for q, s in dealt(keys << CUT, ranges)])

    return run


def _window_messages(n: int, k: int, ranges: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                w1, w2, doc, *_ = _shared(open_batch(batch.column("payload")[i]), _anchors(heard(batch, "anchors", i)), n, k)
                first = np.unique(_heads(w1, w2))
                w1, w2, doc = w1[first], w2[first], doc[first]
                b = batch.column("b")[i].as_py()
                yield from messages([(q, b, pack_sorted(w1[s]), pack_ints(w2[s]), pack_ints(doc[s])) for q, s in dealt(w1, ranges)])

    return run


def _anchors(heard: list[bytes]) -> np.ndarray:
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *(unpack_sorted(x) for x in heard)]))


def _meet(messages: pa.Table) -> pa.Table:
    """All messages of a hash range: to each batch, which of its anchors
    another batch holds too."""
    keys = [unpack_sorted(x.as_py()) for x in messages.column("keys")]
    every = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    return answers(messages, [(pack_sorted(v[member(v, twice)]), b"") for v in keys])


def _least(messages: pa.Table) -> pa.Table:
    """All messages of a hash range: to each batch, which of its windows a
    smaller document than its own smallest holds."""
    w1 = [unpack_sorted(x.as_py()) for x in messages.column("keys")]
    if not w1:
        return answers(messages, [])
    w2 = [unpack_ints(x.as_py()) for x in messages.column("checks")]
    ids = [unpack_ints(x.as_py(), np.int64) for x in messages.column("ids")]
    a, c, d = np.concatenate(w1), np.concatenate(w2), np.concatenate(ids)
    order = np.lexsort((d, c, a))
    gone = np.zeros(len(a), bool)
    gone[order] = d[order] > d[order][_heads(a[order], c[order])]
    cuts = np.cumsum([0, *map(len, w1)])
    return answers(messages, [(pack_sorted(x[gone[p:q]]), pack_ints(y[gone[p:q]])) for x, y, p, q in zip(w1, w2, cuts[:-1], cuts[1:], strict=True)])


def answers(messages: pa.Table, rows: list) -> pa.Table:
    out = pa.table({"b": messages.column("b").combine_chunks().cast(pa.int64()), "keys": pa.array([r[0] for r in rows], pa.binary()), "checks": pa.array([r[1] for r in rows], pa.binary())})
    return out.filter(pc.greater(pc.binary_length(out.column("keys")), 0))


def answered(packed: DataFrame, buckets: int, *answers: tuple[str, DataFrame]) -> DataFrame:
    """The batches, each with the answers it got; only the answers move."""
    out = packed
    for name, df in answers:
        got = df.repartition(buckets, "b").groupBy("b").agg(*[F.collect_list(c).alias(x) for c, x in (("keys", name), ("checks", f"{name}_checks"))])
        out = out.join(got, "b", "left")
    return out


def find_repeats(docs: DataFrame, n: int = 13, k: int = 5, id_col: str = "doc_id", text_col: str = "text", prefix: str = "repeat_",
                 batch_bytes: int = BATCH_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` with ``repeat_words`` (long), ``repeat_spans`` (maximal runs of
    repeated words, by word position) and ``repeat_kept`` (the other words,
    joined by one space)."""
    names = [f"{prefix}{x}" for x in ("words", "spans", "kept")]
    kept = [c for c in docs.columns if c not in names]
    inner = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")) \
        if kept != [id_col, text_col] or dict(docs.dtypes)[id_col] != "bigint" or dict(docs.dtypes)[text_col] != "string" else docs.select(*kept)
    ranges, buckets = parts_of(inner, range_bytes)
    with batch_table(inner, batch_bytes, buckets) as packed:
        deal = packed.select("b", "payload").mapInArrow(_seed_messages(n, k, ranges), MESSAGE_DDL)
        answer = "b long, keys binary, checks binary"
        anchors = materialise(deal.groupBy("q").applyInArrow(_meet, answer), "anchors")
        deal = answered(packed, buckets, ("anchors", anchors)).mapInArrow(_window_messages(n, k, ranges), MESSAGE_DDL)
        windows = materialise(deal.groupBy("q").applyInArrow(_least, answer), "windows")
        schema = inner.limit(0).select("*", F.lit(0).cast("long").alias(names[0]), F.array().cast("array<struct<first:int,past:int>>").alias(names[1]),
                                       F.lit("").alias(names[2])).schema
        done = answered(packed, buckets, ("anchors", anchors), ("windows", windows)).mapInArrow(_cut(n, k, names), schema)
        return materialise(done if inner.columns == kept else done.select("row.*", *names), "repeats")


def _cut(n: int, k: int, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs = open_batch(batch.column("payload")[i])
                w1, w2, doc, at, least, words = _shared(docs, _anchors(heard(batch, "anchors", i)), n, k)
                gone = least < doc
                told = [(unpack_sorted(x), unpack_ints(y)) for x, y in zip(heard(batch, "windows", i), heard(batch, "windows_checks", i), strict=True)]
                if told:
                    x, y = np.concatenate([h[0] for h in told]), np.concatenate([h[1] for h in told])
                    order = np.lexsort((y, x))
                    gone |= _among(w1, w2, x[order], y[order])
                at = np.sort(at[gone])
                ends = np.cumsum(words.counts)
                for r in range(0, docs.num_rows, 2000):
                    yield _result(docs.slice(r, 2000), at, ends[r:r + 2000], words.counts[r:r + 2000], n, names)

    return run


def _among(w1: np.ndarray, w2: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Which pairs (w1, w2) are among the sorted pairs (k1, k2)."""
    found = np.zeros(len(w1), bool)
    at, end = np.searchsorted(k1, w1), np.searchsorted(k1, w1, "right")
    while len(open_ := np.flatnonzero(~found & (at < end))):
        found[open_] = k2[at[open_]] == w2[open_]
        at[open_] += 1
    return found


def _result(docs: pa.RecordBatch, gone: np.ndarray, ends: np.ndarray, counts: np.ndarray, n: int, names: list[str]) -> pa.RecordBatch:
    """The rows of some texts, whose words end at ``ends`` of the batch's."""
    spans, kept = [], []
    firsts = ends - counts
    cuts = np.searchsorted(gone, np.stack([firsts, ends]))
    for text, first, a, b in zip(docs.column(1), firsts.tolist(), *cuts.tolist(), strict=True):
        words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
        own = merged(gone[a:b] - first, n) if a < b else []
        spans.append([{"first": x, "past": y} for x, y in own])
        if own:
            past = [0, *(y for _, y in own)]
            words = [w for x, y in zip(past, [*(x for x, _ in own), len(words)], strict=True) for w in words[x:y]]
        kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
    return pa.RecordBatch.from_arrays([*docs.columns, pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.string())],
                                      names=[*docs.schema.names, *names])


def merged(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The maximal runs of words that windows at sorted places cover."""
    if not len(places):
        return []
    new = np.concatenate([[True], places[1:] > places[:-1] + n])
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(places)) - 1
    return [(int(places[x]), int(places[y]) + n) for x, y in zip(firsts, lasts, strict=True)]


def n_removed(spans: str = "repeat_spans"):
    """Number of words within the spans."""
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda a, s: a + (s["past"] - s["first"]).cast("long"))
