"""SimHash near-duplicates through an index on byte positions.

A fingerprint is eight bytes. Two that differ in at most ``d`` bits differ in
at most ``d`` bytes, so at least ``8 - d`` of their positional bytes are equal:
the guaranteed number of matches. A posting list for one byte of one position
would hold 1/256 of the corpus, so postings are keyed by several positional
bytes at once. For ``d = 3`` the keys are the complements of the 14 blocks of
the quadruple system on eight points: every three positions lie in exactly one
block, hence each near pair agrees on all four bytes of some key. Within a
posting list the equal positional bytes of each pair are tallied, pairs
below the guaranteed minimum are dropped, and the rest verified by counting
differing bits. A task emits, for each posting list, a spanning forest
instead of all pairs; components join these up.

Only distinct fingerprints are indexed, so copies never meet in a posting
list. A list of more than ``LIST_ROWS`` fingerprints is split by one further
positional byte (for ``d = 3`` one more must be equal); such a list
fixes five bytes and so can hold no more than 2**24 entries.

Defined cases: a null or blank text has no words and the fingerprint zero,
which links like any other. Rows with a null id take part; a component's id is
the smallest non-null id in it (null if it has none). Repeated rows come back
as often as given. An empty table gives no rows. Columns other than the
named id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwise.llm.common import batch_rows, free_name, id_and_text, materialise, to_batches
from chartwise.llm.graph import components

LIST_ROWS = 1 << 16
_CHUNK = 1 << 15
#: Lists up to this length are searched together, and may give all their near pairs.
_SHORT = 8
_SEED = 42


def shingles(words: list[bytes], width: int) -> list[bytes]:
    """All runs of ``width`` words, repeats included; a shorter text is one
    shingle; no words, none."""
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half the shingle hashes."""
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and \x20 \x09-\x0D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ones = np.zeros(64, np.int64)
    total = max(1, len(words) - width + 1)
    for at in range(0, total, _CHUNK):
        part = shingles(words[at:at + _CHUNK + width - 1], width)
        h = np.fromiter((xxhash.xxh64_intdigest(s, _SEED) for s in part), np.uint64, len(part))
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): fp as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for i, text in batch_rows(batches):
                f = fingerprint(text, width)
                yield i, f - (1 << 64) if f >> 63 else f
        return to_batches(rows(), schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def key_positions(distance: int) -> list[tuple[int, ...]]:
    """Byte positions of each index key: any two fingerprints within
    ``distance`` bits agree on all positions of at least one of them."""
    if not 0 <= distance <= 7:
        raise ValueError("distance must be 0 to 7 bits")
    if distance == 3:
        spared = [b for b in combinations(range(8), 4) if b[0] ^ b[1] ^ b[2] ^ b[3] == 0]
    else:
        spared = list(combinations(range(8), distance))
    return [tuple(p for p in range(8) if p not in s) for s in spared]


def _mask(positions: Iterable[int]) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >> 63 else m


def join_pairs(parent: np.ndarray, a: np.ndarray, b: np.ndarray, same: Callable[[int, int], bool] | None = None) -> None:
    """Union the pairs (a, b) in a parent array, the smaller being the root;
    with ``same``, only those it holds for. Pairs already joined aren't asked."""
    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(i), root(j)
        if x != y and (same is None or same(i, j)):
            parent[max(x, y)] = min(x, y)


def roots(parent: np.ndarray) -> np.ndarray:
    out = parent
    while (out != out[out]).any():
        out = out[out]
    return out


def near_in_list(fps: np.ndarray, distance: int) -> np.ndarray:
    """Parents of a spanning forest over the near pairs of one posting list."""
    m = len(fps)
    parent = np.arange(m)
    at, step, most = 0, 1, max(1, (1 << 19) // m)
    while at < m - 1:
        x = fps[at:at + step, None] ^ fps[None, at + 1:]
        # tally of equal positional bytes; pairs with too few are not verified
        equal = (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=2, dtype=np.uint8)
        i, j = np.nonzero(equal >= 8 - distance)
        ok = (j + 1 > i) & (np.bitwise_count(x[i, j]) <= distance)
        i, j = i[ok] + at, j[ok] + at + 1
        if len(i):
            label = roots(parent)
            apart = label[i] != label[j]
            join_pairs(parent, i[apart], j[apart])
        at, step = at + step, min(2 * step, most)
    return roots(parent)


def _near_by_masks(fps: np.ndarray, distance: int, free: list[int]) -> np.ndarray:
    """The same for a very long list whose other bytes are all equal: looks
    up each fingerprint with every set of up to ``distance`` bits flipped, so
    work grows with the list and not with its square."""
    order = np.argsort(fps)
    ranked = fps[order]
    parent = np.arange(len(fps))
    bits = [8 * p + k for p in free for k in range(8)]
    for n in range(1, distance + 1):
        for flip in combinations(bits, n):
            other = ranked ^ np.uint64(sum(1 << b for b in flip))
            at = np.minimum(np.searchsorted(ranked, other), len(ranked) - 1)
            hit = np.nonzero((ranked[at] == other) & (ranked < other))[0]
            if len(hit):
                join_pairs(parent, order[hit], order[at[hit]])
    return roots(parent)


def whole_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, bounds of the runs) from rows sorted by the first column: runs
    of equal value there, each whole in one piece, though it may span
    batches."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t])
        if not len(t):
            continue
        edges = np.concatenate([[0], np.flatnonzero(np.diff(t.column(0).to_numpy())) + 1])
        if len(edges) > 1:
            yield t.slice(0, edges[-1]), edges
        held = t.slice(edges[-1])
    if held is not None and len(held):
        yield held, np.array([0, len(held)])


def posting_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of more than one row of equal first column, from rows sorted by it."""
    for t, edges in whole_lists(batches):
        sizes = np.diff(edges)
        for k in np.flatnonzero(sizes > 1):
            yield t.slice(edges[k], sizes[k])


def _near_in_short_lists(fps: np.ndarray, edges: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): the near pairs in all lists of up to ``_SHORT`` entries at once."""
    sizes = np.diff(edges)
    number = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero((sizes[number] > 1) & (sizes[number] <= _SHORT))
    first, second = [], []
    for step in range(1, _SHORT):
        i = at[at + step < len(fps)]
        i = i[number[i + step] == number[i]]
        x = fps[i] ^ fps[i + step]
        equal = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1, dtype=np.uint8)
        i, x = i[equal >= 8 - distance], x[equal >= 8 - distance]
        i = i[(np.bitwise_count(x) <= distance) & (x != 0)]
        first.append(i)
        second.append(i + step)
    return np.concatenate(first), np.concatenate(second)


def _links(index: DataFrame, positions: list[tuple[int, ...]], distance: int, split_over: int | None) -> DataFrame:
    """index (key, fp) -> (u, v): links, or for a list longer than
    ``split_over`` its entries as (fp, null)."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def in_list(signed: np.ndarray):
        signed = np.unique(signed)
        fps = signed.view(np.uint64)
        if split_over and len(fps) > split_over:
            yield from ((int(x), None) for x in signed)
            return
        if len(fps) > LIST_ROWS:
            parent = _near_by_masks(fps, distance, [p for p in range(8) if len(np.unique(fps >> np.uint64(8 * p) & np.uint64(255))) > 1])
        else:
            parent = near_in_list(fps, distance)
        for i in np.flatnonzero(parent != np.arange(len(parent))):
            yield int(signed[i]), int(signed[parent[i]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in whole_lists(batches):
            signed = t.column(1).to_numpy()
            i, j = _near_in_short_lists(signed.view(np.uint64), edges, distance)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(signed[i], pa.int64()), pa.array(signed[j], pa.int64())], schema=schema)
            for k in np.flatnonzero(np.diff(edges) > _SHORT):
                yield from to_batches(in_list(signed[edges[k]:edges[k + 1]]), schema)

    return index.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


def index_keys(positions: list[tuple[int, ...]]) -> list[tuple[int, int]]:
    """(mask, mark) of each key: a key is the masked fingerprint with the
    number of its set of positions in a byte that the set spares, so one
    long is enough to sort by. Lists of two sets could meet in one long; that
    makes a longer list, whose pairs are verified all the same."""
    out = []
    for k, p in enumerate(positions):
        spared = [x for x in range(8) if x not in p]
        mark = k << (8 * spared[0]) if spared else 0
        out.append((_mask(p), mark - (1 << 64) if mark >> 63 else mark))
    return out


def index_rows(df: DataFrame, positions: list[tuple[int, ...]]) -> DataFrame:
    """A row (key, and the columns of ``df``) for each key of each
    fingerprint fp."""
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(mask).cast("long")).bitwiseOR(F.lit(mark).cast("long")) for mask, mark in index_keys(positions)])
    return df.select(F.explode(keys).alias("key"), *df.columns)


def finer_positions(positions: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Each set of positions with one more, in every way."""
    return sorted({tuple(sorted((*p, x))) for p in positions for x in range(8) if x not in p})


def near_links(fps: DataFrame, distance: int = 3, list_rows: int = LIST_ROWS) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints in ``fps`` (fp:
    long) exactly as all pairs within ``distance`` bits would."""
    positions = key_positions(distance)
    first = index_rows(fps, positions)
    if distance != 3:
        return _links(first, positions, distance, None)
    found = materialise(_links(first, positions, distance, list_rows), "simhash-links")
    # entries of long lists again, with one more positional byte in the key
    finer = finer_positions(positions)
    second = index_rows(found.filter(F.col("v").isNull()).select(F.col("u").alias("fp")).distinct(), finer)
    return found.filter(F.col("v").isNotNull()).unionAll(_links(second, finer, distance, None))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    distance: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): one row for each row of ``docs``."""
    each = materialise(fingerprints(docs, id_col, text_col, width), "simhash")
    kinds = materialise(each.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-kinds")
    groups = components(near_links(kinds.select("fp"), distance))
    known = materialise(kinds.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
                        .select("fp", F.coalesce("component", "fp").alias("label"), "first_id"), "simhash-labels")
    ids = known.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of = known.join(ids, "label").select("fp", "component_id")
    return each.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` without near-duplicates: of each group the rows with the
    smallest id stay. A row is told by its id and fingerprint, so another text
    of the same id is decided by its own group. Rows of a group without any id
    stay."""
    groups = near_duplicates(docs, id_col, text_col, width, distance)
    row_id, row_fp = free_name("_id", docs.columns), free_name("_fp", docs.columns)
    lost = groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(row_id), F.col("fp").alias(row_fp)).distinct()

    @F.pandas_udf("long")
    def fp_of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    own = docs.withColumn(row_fp, fp_of(F.col(text_col).cast("string")))
    same = own[id_col].cast("long").eqNullSafe(lost[row_id]) & (own[row_fp] == lost[row_fp])
    return own.join(lost, same, "left_anti").drop(row_fp)
