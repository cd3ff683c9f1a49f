"""Phrase collocations by sorted suffixes.

Texts, A-Z lower-cased, are cut at ``.,;:!?`` and line breaks into pieces, and
those at spaces and tabs into words. Of each language's phrases of 2 to ``most``
words, counted in pieces with all overlaps, those that occur ``least`` times
are candidates. A candidate of count ``a`` cut after its first ``k`` words, with
counts ``l`` and ``r`` of the parts, scores ``floor(2000000 * a / (l + r))``;
its lowest cut counts, the smallest ``k`` at ties. A candidate that lies within
a longer one of at least ``cover`` per cent of its count goes.

* *Routing.* Texts lie in batches (as in ``substrings``). Each batch counts its
  words and neighbouring pairs; their sums by hash range tell every batch which
  of its pairs are frequent. A word then leads a suffix of up to ``most`` words,
  as far as its pairs are frequent (no longer phrase can be); each batch sends
  its distinct suffixes once, with counts, to a task by their leading words.
* *Sorting.* The task sorts pointers to its suffixes by multikey three-way
  quicksort, one word deeper in each equal part down to ``most`` words. The
  count of an equal part is its phrase's; a part below ``least`` is abandoned.

Suffixes are routed by three leading words, so a word or a pair in a third of
all places is dealt over as many tasks as words follow it; the counts of single
words and pairs, which several tasks find, are added up after.

Defined cases: null and blank texts have no words; a null language is ``und``,
together with texts that name it so. Repeated rows count as often as they stand.
Nothing depends on ids or other columns. Empty tables give no rows. A text of
any length is one batch at most. Counts are exact, as is the arithmetic
(decimals of 38 digits).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartwise.llm.common import materialise, to_batches
from chartwise.llm.substrings import (
    BATCH_BYTES,
    MESSAGE_DDL,
    answered,
    answers,
    batch_table,
    dealt,
    grams,
    heard,
    member,
    messages,
    open_batch,
    pack_ints,
    parts_of,
    unpack_ints,
)
from chartwise.llm.words import Alphabet, Words, mixed, words_of

#: Text for each hash range of keys, and such ranges for one of suffixes: the fewer, the less often words are spelt out.
RANGE_BYTES, SUFFIX_RANGES = 16 << 20, 2
UNKNOWN = "und"
#: Words lie between spaces and tabs, pieces between marks and line breaks.
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
WORDS = Alphabet(b" \t", b".,;:!?\n\v\f\r", lower=True)


def _keys(batch: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a batch of (language, text); their hashes, each language
    its own; those of neighbouring pairs, and whether a pair is in one piece."""
    words = words_of(batch.column(1), WORDS)
    langs = pc.dictionary_encode(batch.column(0))
    seeds = np.fromiter((xxhash.xxh3_64_intdigest(x.as_py().encode()) | 1 for x in langs.dictionary), np.uint64, len(langs.dictionary))
    hashes = mixed(words.hashes * seeds[langs.indices.to_numpy()[words.row]]) if len(words.row) else words.hashes
    return words, hashes, grams(hashes, 2), words.piece[1:] == words.piece[:-1]


def key_cut(text_bytes: int) -> np.uint64:
    """How many low bits of a hash are left out of keys: those kept tell some
    thousand times as many keys apart as there are words. A chance match costs
    a suffix sent in vain."""
    return np.uint64(max(16, 64 - (text_bytes.bit_length() + 10)))


def pack_keys(v: np.ndarray) -> bytes:
    """Sorted numbers as steps, each byte of them apart, squeezed."""
    return squeezed(np.ascontiguousarray(np.diff(v, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_keys(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueezed(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _count_messages(ranges: int, least: int, cut: np.uint64):
    """Of each batch its words and pairs, by hash, with counts up to ``least``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, hashes, pairs, joined = _keys(open_batch(batch.column("payload")[i]))
                keys, counts = np.unique(np.concatenate([hashes, pairs[joined]]) >> cut, return_counts=True)
                counts = np.minimum(counts, least)
                b = batch.column("b")[i].as_py()
                yield from messages([(q, b, pack_keys(keys[s]), squeezed(pack_ints(counts[s])), b"") for q, s in dealt(keys << cut, ranges)])

    return run


def _frequent(least: int):
    """All counts of a hash range: to each batch, which of its keys are frequent."""
    def run(got: pa.Table) -> pa.Table:
        keys = [unpack_keys(x.as_py()) for x in got.column("keys")]
        if not keys:
            return answers(got, [])
        distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(of, np.concatenate([unpack_ints(unsqueezed(x.as_py()), np.int64) for x in got.column("checks")]))
        known = distinct[total >= least]
        return answers(got, [(pack_keys(v[found]) if (found := member(v, known)).any() else b"", b"") for v in keys])

    return run


def _suffix_messages(ranges: int, most: int, cut: np.uint64):
    """Of each batch its distinct suffixes with counts, to tasks by leading
    words: (q, words, symbols, counts). Suffixes are rows of numbers of the
    words that are sent along; the language, in hex behind a tab, comes first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                known = np.sort(np.concatenate([np.zeros(0, np.uint64), *(unpack_keys(x) for x in heard(batch, "known", i))]))
                docs = open_batch(batch.column("payload")[i])
                yield from _suffixes(docs, known, ranges, most, cut)

    return run


def _suffixes(docs: pa.RecordBatch, known: np.ndarray, ranges: int, most: int, cut: np.uint64) -> Iterator[pa.RecordBatch]:
    words, hashes, pairs, joined = _keys(docs)
    n = len(hashes)
    if not n:
        return
    distinct, first_of, ids = np.unique(hashes, return_index=True, return_inverse=True)
    on = member(distinct >> cut, known)  # frequent words
    pair = np.zeros(n, bool)
    pair[:-1] = joined & member(pairs >> cut, known)
    reach = on[ids]
    rows = [np.where(reach, ids, -1)]  # suffixes as rows of word numbers, -1 past their ends
    for k in range(1, most):
        reach = reach & np.concatenate([pair[k - 1:], np.zeros(k - 1, bool)])
        rows.append(np.where(reach, np.concatenate([ids[k:], np.zeros(k, np.int64)])[:n], -1))
    rows = np.stack(rows)
    langs = pc.dictionary_encode(docs.column(0))
    lang_of = langs.indices.to_numpy().astype(np.int64)[words.row]
    lone = rows[0] < 0  # counted with no word at all
    empty = np.bincount(lang_of[lone], minlength=len(langs.dictionary))
    rows, counts = distinct_columns(np.concatenate([lang_of[None, ~lone], rows[:, ~lone]]))
    ends = np.full((most + 1, len(empty)), -1)
    ends[0] = np.arange(len(empty))
    rows, counts = np.concatenate([rows, ends], axis=1), np.concatenate([counts, empty])
    raw = words.raw.tobytes()
    names = [b"\t" + x.as_py().encode().hex().encode() for x in langs.dictionary]
    spelt = lambda x: raw[words.starts[first_of[x]]:words.ends[first_of[x]]].translate(_LOWER)
    route = _fold_rows(np.append(distinct, np.uint64(0))[rows[1:4]])
    order = np.argsort(route, kind="stable")
    for q, s in dealt(route[order], ranges):
        at = np.sort(order[s])  # in order of words again: alike rows together pack well
        used, own = np.unique(rows[1:, at], return_inverse=True)
        table = [*names, *(b"" if x < 0 else spelt(x) for x in used.tolist())]
        symbols = np.concatenate([rows[:1, at], own.reshape(most, -1) + len(names)])
        yield pa.RecordBatch.from_arrays([pa.array([q], pa.int32()), *(pa.array([squeezed(x)], pa.binary()) for x in (b"\n".join(table), pack_planes(symbols), pack_ints(counts[at])))],
                                         names=["q", "words", "symbols", "counts"])


def pack_planes(symbols: np.ndarray) -> bytes:
    """Each row of numbers less the one before it, low bytes apart from high
    ones: what changes little packs to little."""
    steps = np.diff(symbols, axis=1, prepend=0).astype("<i4")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(len(symbols), -1, 4).transpose(0, 2, 1)).tobytes()


def unpack_planes(raw: bytes, rows: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(rows, 4, -1).transpose(0, 2, 1)
    return np.cumsum(np.ascontiguousarray(planes).view("<i4").reshape(rows, -1), axis=1)


def squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unsqueezed(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)


#: Rows of up to so many bits are sorted as one number.
KEY_BITS = 63


def distinct_columns(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different columns of a matrix of numbers from -1 on, and how often
    each occurs."""
    if not rows.size:
        return rows, np.zeros(0, np.int64)
    # numbers made dense first, so that few bits do
    dense, tops = [], []
    for row in rows:
        seen = np.zeros(row.max() + 2, np.int64)
        seen[row + 1] = 1
        dense.append((np.cumsum(seen) - 1)[row + 1])
        tops.append(int(seen.sum() - 1).bit_length())
    if sum(tops) <= KEY_BITS:
        key = np.zeros(rows.shape[1], np.int64)
        for row, bits in zip(dense, tops, strict=True):
            key = (key << bits) | row
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        return rows[:, first], counts
    order = np.lexsort(rows[::-1])
    rows = rows[:, order]
    first = np.flatnonzero(np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)]))
    return rows[:, first], np.diff(np.append(first, rows.shape[1]))


def _fold_rows(h: np.ndarray) -> np.ndarray:
    """One hash of each column."""
    out = np.zeros(h.shape[1], np.uint64)
    for row in h:
        out = (out + row) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def sorted_counts(symbols: np.ndarray, weights: np.ndarray, least: int, whole: int) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers to the columns of ``symbols``
    (-1 past a suffix's end). Yields (a pointer, depth, count) of each equal
    part: ``count`` suffixes share their first ``depth`` symbols. Parts whose
    suffixes share ``whole`` symbols or more are complete here, and abandoned
    below ``least``."""
    stack = [(np.arange(symbols.shape[1]), 0)]
    while stack:
        at, depth = stack.pop()
        if depth >= whole and weights[at].sum() < least:
            continue
        here = symbols[depth, at]
        if len(at) == 1:
            while depth < len(symbols) and symbols[depth, at[0]] >= 0 and (depth < whole or weights[at[0]] >= least):
                depth += 1
                yield int(at[0]), depth, int(weights[at[0]])
            continue
        pivot = here[len(here) // 2]
        less, equal, more = at[here < pivot], at[here == pivot], at[here > pivot]
        stack += [(x, depth) for x in (less, more) if len(x)]
        if pivot >= 0:
            count = int(weights[equal].sum())
            if depth < whole or count >= least:
                yield int(equal[0]), depth + 1, count
                if depth + 1 < len(symbols):
                    stack.append((equal, depth + 1))


def _sort(least: int, most: int):
    """All suffixes of some leading words: the counts of their phrases."""
    out = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("a", pa.int64())])

    def run(got: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        symbols, counts = [], []
        for words, symbol, count in zip(*(got.column(x) for x in ("words", "symbols", "counts")), strict=True):
            own = np.array([number.setdefault(w, len(number)) if w else -1 for w in unsqueezed(words.as_py()).split(b"\n")], np.int32)
            symbols.append(own[unpack_planes(unsqueezed(symbol.as_py()), most + 1)])
            counts.append(unpack_ints(unsqueezed(count.as_py()), np.int64))
        symbols, counts, spelt = np.concatenate(symbols, axis=1), np.concatenate(counts), list(number)
        found = ((bytes.fromhex(spelt[symbols[0, at]][1:].decode()).decode(), b" ".join(spelt[x] for x in symbols[1:depth, at].tolist()).decode("utf-8", "surrogatepass"),
                  depth - 1, count) for at, depth, count in sorted_counts(symbols, counts, least, 3))
        return pa.Table.from_batches(list(to_batches(found, out)), schema=out)

    return run


def frequent_phrases(docs: DataFrame, least: int = 30, most: int = 4, lang_col: str = "lang", text_col: str = "text", batch_bytes: int = BATCH_BYTES,
                     range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(lang, phrase, words, a): all phrases of up to ``most`` words that occur
    ``least`` times, materialised; the empty phrase, of 0 words, has the number
    of all words."""
    inner = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    ranges, buckets = parts_of(inner, range_bytes)
    cut = key_cut(ranges * range_bytes)
    with batch_table(inner, batch_bytes, buckets) as packed:
        told = packed.select("b", "payload").mapInArrow(_count_messages(ranges, least, cut), MESSAGE_DDL)
        known = materialise(told.groupBy("q").applyInArrow(_frequent(least), "b long, keys binary, checks binary"), "frequent-pairs")
        sent = answered(packed, buckets, ("known", known)).mapInArrow(_suffix_messages(-(-ranges // SUFFIX_RANGES), most, cut), "q int, words binary, symbols binary, counts binary")
        parts = sent.groupBy("q").applyInArrow(_sort(least, most), "lang string, phrase string, words int, a long")
        return materialise(parts.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).filter((F.col("a") >= least) | (F.col("words") == 0)), "phrases")


def _part(first, size):
    return F.array_join(F.slice("w", first, size), " ")


def collocations(docs: DataFrame, least: int = 30, most: int = 4, cover: int = 80, top: int | None = 2000, **names) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top``
    candidates (all, if None)."""
    counted = frequent_phrases(docs, least, most, **names)
    several = counted.filter(F.col("words") > 1).withColumn("w", F.split("phrase", " "))
    cuts = several.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")) \
        .select("lang", "phrase", "words", "a", "k", _part(F.lit(1), F.col("k")).alias("head"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    single = counted.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    both = cuts.join(single.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"]) \
        .join(single.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    scored = both.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low"))
    inside = several.filter(F.col("words") > 2) \
        .select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")) \
        .select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at")) \
        .groupBy("lang", _part(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    whole = counted.filter(F.col("words") == 0).select("lang", F.col("a").alias("n"))
    kept = scored.join(inside, ["lang", "phrase"], "left") \
        .filter(F.col("longer").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("longer") < F.lit(cover) * F.col("a").cast("decimal(20,0)"))) \
        .join(whole, "lang").select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", rank)
    return (ranked.filter(F.col("rank") <= top) if top else ranked).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
