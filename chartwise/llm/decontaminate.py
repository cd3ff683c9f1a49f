"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are runs of digits, letters a-z and non-ASCII characters after
lower-casing A-Z. Each benchmark item gives windows of ``n`` consecutive words
(a shorter item one window of all its words). The windows' hashes are
broadcast; every window of every document is hashed and looked up, and a hit
counts only once its words equal the benchmark window's. No shuffle: documents
are scanned where they lie.

The broadcast is bounded: a benchmark larger than ``block_bytes`` of text is
taken in blocks of about that size, each a scan over the documents with hits
so far carried along. An item of the size of a block or more makes its block
that much larger.

Defined cases: null and blank texts have no words and are clean; null, blank
and repeated items are allowed (blank ones match nothing, repeated ids count
once, an item without an id is an item of its own called ''). An empty
benchmark leaves every document clean. Repeated rows are judged one by one.
Columns of the documents are kept when filtering, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwise.llm.common import materialise

BLOCK_BYTES = 16 << 20
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Byte map: A-Z to a-z, bytes of words as they are, all others to a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MULTIPLIER = 0x9E3779B97F4A7C15
_BITMAP_BITS = 20


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def window_hash(columns: np.ndarray) -> np.ndarray:
    """Hashes of windows given as one array of word numbers per position."""
    h = np.zeros(columns.shape[1], np.uint64)
    for column in columns:
        h = (h + column) * np.uint64(_MULTIPLIER)
        h ^= h >> np.uint64(29)
    return h


def window_set(items: Iterable[tuple[str, str | None]], n: int) -> dict:
    """The windows of some benchmark items, for ``window_hits``: numbers of
    their words; for each window (as word numbers) the items that hold it; and
    by window length the sorted hashes, with a bitmap of their leading bits."""
    numbers: dict[bytes, int] = {}
    windows: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in folded(text).split()]
        size = min(n, len(ids))
        for at in range(len(ids) - size + 1 if size else 0):
            windows.setdefault(tuple(ids[at:at + size]), set()).add(item)
    hashes, bitmaps = {}, {}
    for size in sorted({len(w) for w in windows}):
        hashes[size] = np.unique(window_hash(np.array([w for w in windows if len(w) == size], np.uint64).T))
        bitmaps[size] = np.zeros(1 << _BITMAP_BITS, bool)
        bitmaps[size][hashes[size] >> np.uint64(64 - _BITMAP_BITS)] = True
    return {"numbers": numbers, "windows": windows, "hashes": hashes, "bitmaps": bitmaps}


def window_hits(known: dict, words: list[bytes]) -> list[tuple[int, int, set[str]]]:
    """(first word, past the last, items) of each benchmark window found."""
    found = []
    get = known["numbers"].get
    ids = np.array([get(w, 0) for w in words], np.uint64)
    unknown = np.concatenate([[0], np.cumsum(ids == 0)])
    for size, hashes in known["hashes"].items():
        if len(ids) < size:
            continue
        at = np.flatnonzero(unknown[size:] == unknown[:-size])  # windows of known words only
        if not len(at):
            continue
        h = window_hash(np.stack([ids[at + k] for k in range(size)]))
        maybe = known["bitmaps"][size][h >> np.uint64(64 - _BITMAP_BITS)]
        at, h = at[maybe], h[maybe]
        near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        for a in at[hashes[near] == h].tolist():
            if items := known["windows"].get(tuple(ids[a:a + size].tolist())):
                found.append((a, a + size, items))
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_SCHEMA = "array<struct<first:int,past:int>>"


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """(i, t) of the items, in blocks of about ``block_bytes`` of text each."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).cast("string").alias("t")) \
        .filter(F.col("t").isNotNull())
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    items = items.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(count)))
    return [items.filter(F.col("b") == k).select("i", "t") for k in range(count)]


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = 13, text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, prefix: str = "hit_") -> DataFrame:
    """``docs`` with ``hit_words`` (long), ``hit_spans`` (merged runs of hit
    words, by word position) and ``hit_items`` (sorted ids, as strings). Columns
    of ``docs`` that have one of these names are replaced."""
    spark = docs.sparkSession
    names = [f"{prefix}{x}" for x in ("words", "spans", "items")]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    inner = docs.select(F.struct(*kept).alias("row"), F.col(text_col).cast("string").alias("text"),
                        F.lit(0).cast("long").alias("n"), F.array().cast(_SCHEMA).alias("spans"), F.array().cast("array<string>").alias("items"))
    out = T.StructType([T.StructField("row", inner.schema["row"].dataType), *inner.schema.fields[1:]])
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    for k, block in enumerate(blocks):
        windows = window_set(((r.i, r.t) for r in block.collect()), n)
        inner = _scan(inner, spark.sparkContext.broadcast(windows), out)
        if k < len(blocks) - 1:
            inner = materialise(inner, "decontaminate")
    return inner.select("row.*", F.col("n").alias(names[0]), F.col("spans").alias(names[1]), F.col("items").alias(names[2]))


def _scan(df: DataFrame, windows, schema: T.StructType) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, spans, items = [], [], []
            for i in range(b.num_rows):
                words = folded(b.column(1)[i].as_py()).split()
                found = window_hits(windows.value, words)
                n.append(len(words))
                before, had = b.column(3)[i].as_py(), b.column(4)[i].as_py()
                if found:
                    merged = _merged([(x["first"], x["past"]) for x in before] + [x[:2] for x in found])
                    before = [{"first": x, "past": y} for x, y in merged]
                    had = sorted(set(had).union(*(x[2] for x in found)))
                spans.append(before)
                items.append(had)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(spans, b.schema.field(3).type), pa.array(items, b.schema.field(4).type)],
                names=b.schema.names)

    return df.mapInArrow(run, schema)


def cut_spans(text: str | None, spans: list) -> str | None:
    """The text without the given runs of words (and what lies within them)."""
    if text is None or not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    out, last = [], 0
    for s in spans:
        first, past = (s["first"], s["past"]) if not isinstance(s, tuple) else s
        out.append(raw[last:at[first][0]])
        last = at[past - 1][1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


def n_hit(spans: str = "hit_spans"):
    """Number of words within merged spans."""
    return F.coalesce(F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda a, s: a + (s["past"] - s["first"]).cast("long")), F.lit(0).cast("long"))


def is_contaminated(words: str = "hit_words", spans: str = "hit_spans", one_in: int = 20):
    """At least one word in ``one_in`` is hit."""
    return (n_hit(spans) > 0) & (F.lit(one_in) * n_hit(spans) >= F.col(words))


def _free_prefix(docs: DataFrame) -> str:
    prefix = "_hit_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return prefix


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 13, one_in: int = 20, **names) -> DataFrame:
    """``docs`` without the contaminated ones."""
    keep = [F.col(f"`{c}`") for c in docs.columns]
    own = _free_prefix(docs)
    return find_hits(docs, benchmark, n, prefix=own, **names).filter(~is_contaminated(f"{own}words", f"{own}spans", one_in)).select(*keep)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13, text_col: str = "text", **names) -> DataFrame:
    """``docs`` with every hit run of words cut out of its text."""
    keep = docs.columns
    own = _free_prefix(docs)
    hit = find_hits(docs, benchmark, n, text_col=text_col, prefix=own, **names)
    cols = [*keep, f"{own}spans"]
    schema = docs.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text_col)
            spans = b.column(b.num_columns - 1)
            text = pa.array([cut_spans(b.column(at)[i].as_py(), spans[i].as_py()) for i in range(b.num_rows)], b.schema.field(at).type)
            arrays = [text if k == at else b.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays(arrays, names=keep)

    return hit.select(*[F.col(f"`{c}`") for c in cols]).mapInArrow(run, schema)
