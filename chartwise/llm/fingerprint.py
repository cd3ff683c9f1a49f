"""Document fingerprints by consistent weighted sampling.

A document is a weighted set: its words, lower-cased, and its pairs of
neighbouring words, with their counts as weights. For each of ``samples``
independent samples, every term draws gamma-distributed r and c and a uniform
b from a hash of (term, sample); with t = floor(ln w / r + b) and
ln a = ln c - r (t - b + 1), the sample is the (term, t) of smallest a. Two
documents' samples are equal with a probability of exactly their generalised
Jaccard similarity, sum of minima over sum of maxima of the weights.

The draws come from hashes of 64 bits: 16 bits each choose a quantile of
Gamma(2, 1) for r and for c (midpoints of 2**16 equal shares), and 32 bits give b.
A sample is kept as 16 bits of a hash of (term, t), so unequal samples look
equal once in 65,536.

Defined cases: a null, empty or blank text has no terms; its fingerprint is the
empty string, which is like another empty one (1) and unlike all others (0).
Very long texts are sampled whole, in slices. Equal texts have equal
fingerprints, wherever they stand. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwise.llm.common import Recent, batch_rows, id_and_text, to_batches

SAMPLES = 64
#: Text of a bucket of neighbouring ids, if the shuffle has fewer partitions than that takes.
BUCKET_BYTES = 32 << 20
_BITS = 16
_SLICE = 512


def gamma_quantiles(bits: int = _BITS) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the midpoints of 2**bits equal shares, by
    Newton steps on 1 - (1 + x) exp(-x) = u."""
    u = (np.arange(1 << bits) + 0.5) / (1 << bits)
    x = np.where(u < 0.5, np.sqrt(2 * u), 2 - np.log1p(-u))
    for _ in range(60):
        e = np.exp(-x)
        step = (1 - (1 + x) * e - u) / (x * e)
        x = np.maximum(x - np.clip(step, -1, 1), x / 4)
    return x


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def weighted(words: np.ndarray, pairs: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the terms, words and with ``pairs`` neighbouring ones too, in
    rising order, their counts), from the words' hashes."""
    return np.unique(np.concatenate([words, _pair_hashes(words[:-1], words[1:])]) if pairs else words, return_counts=True)


def _parted(a: tuple, b: tuple) -> list[tuple]:
    """Weighted terms that two sets share, weights included, those of the
    first alone, and those of the second alone."""
    if not len(a[0]) or not len(b[0]):
        return [tuple(x[:0] for x in a), a, b]
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    same = (a[0][at] == b[0]) & (a[1][at] == b[1])
    left = np.ones(len(a[0]), bool)
    left[at[same]] = False
    return [tuple(x[same] for x in b), tuple(x[left] for x in a), tuple(x[~same] for x in b)]


def sampler(samples: int | None = None, pairs: bool | None = None) -> Callable[..., tuple[np.ndarray | None, ...]]:
    """The function (text, ...) -> for each text its samples as 16-bit integers
    (None: no terms). Terms are words, with ``pairs`` neighbouring ones too; without
    arguments it is the operator's own, ``SAMPLES`` samples of both. Two texts
    are sampled together: what they share is drawn and searched once, so a text
    and its edited version cost little more than one.

    Its attribute ``hashed`` gives the hashes of a text's words, and ``of_words``
    the samples of one or two texts from such hashes."""
    pairs = samples is None if pairs is None else pairs
    samples = samples or SAMPLES
    g = gamma_quantiles()
    r_of, c_of = g.astype(np.float32), np.log(g).astype(np.float32)
    seeds = np.array([xxhash.xxh32_intdigest(f"sample {k}".encode()) | 1 for k in range(2 * samples)], np.uint32).reshape(2, samples, 1)
    every = np.arange(samples)
    hashes = Recent(word_hash)
    # arrays that are used again for each slice
    spare = [np.empty(samples * _SLICE, kind) for kind in (np.uint32, np.uint32, np.int64, np.float32, np.float32, np.float32, np.float32)]

    def draws(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """r, ln c and b of each sample and term."""
        x, y, at, r, c, b, _ = (v[:samples * len(terms)].reshape(samples, -1) for v in spare)
        low, high = (terms & np.uint64(0xFFFFFFFF)).astype(np.uint32), (terms >> np.uint64(32)).astype(np.uint32)
        np.bitwise_xor(low, seeds[0], out=x)
        x *= np.uint32(0x85EBCA6B)
        np.right_shift(x, np.uint32(13), out=y)
        x ^= y
        x *= np.uint32(0xC2B2AE35)
        np.right_shift(x, np.uint32(16), out=y)
        x ^= y
        np.right_shift(x, np.uint32(_BITS), out=y)
        np.copyto(at, y)
        r_of.take(at, mode="clip", out=r)
        np.bitwise_and(x, np.uint32((1 << _BITS) - 1), out=y)
        np.copyto(at, y)
        c_of.take(at, mode="clip", out=c)
        x += high  # the term's other bits
        x *= seeds[1]
        np.right_shift(x, np.uint32(15), out=y)
        x ^= y
        x *= np.uint32(0x9E3779B1)
        np.copyto(b, x, casting="unsafe")
        b *= np.float32(2.0 ** -32)
        return r, c, b

    def smallest(groups: list[tuple]) -> list[tuple | None]:
        """Of each group of (terms, counts), for each sample: the smallest ln a,
        its term's hash and its t. Equal ones go by term."""
        terms, counts = (np.concatenate(x) for x in zip(*groups, strict=True))
        edges = np.cumsum([0, *(len(x[0]) for x in groups)]).tolist()
        best: list = [None] * len(groups)
        for at in range(0, len(terms), _SLICE):
            some, weights = terms[at:at + _SLICE], counts[at:at + _SLICE]
            r, c, b = draws(some)
            a = spare[-1][:samples * len(some)].reshape(samples, -1)
            np.subtract(b, np.float32(1), out=a)  # for a weight of 1, t is 0
            more = np.flatnonzero(weights > 1)
            place = np.full(len(some), -1)
            place[more] = np.arange(len(more))
            t = np.floor(np.log(weights[more]).astype(np.float32) / r[:, more] + b[:, more])
            a[:, more] -= t
            a *= r
            a += c  # ln c - r (t - b + 1)
            for k in range(len(groups)):
                lo, hi = max(edges[k] - at, 0), min(edges[k + 1] - at, len(some))
                if lo >= hi:
                    continue
                found = a[:, lo:hi].argmin(axis=1) + lo
                t_found = np.zeros(samples, np.int64)
                if len(more):
                    where = place[found]
                    t_found = np.where(where >= 0, t[every, where], 0).astype(np.int64)
                best[k] = lesser(best[k], (a[every, found], some[found], t_found))
        return best

    def lesser(one: tuple | None, other: tuple | None) -> tuple | None:
        if one is None or other is None:
            return other if one is None else one
        less = (other[0] < one[0]) | ((other[0] == one[0]) & (other[1] < one[1]))
        return tuple(np.where(less, n, o) for n, o in zip(other, one, strict=True))

    def hashed(text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))

    def of_words(*words: np.ndarray) -> tuple[np.ndarray | None, ...]:
        own = [weighted(w, pairs) for w in words]
        if len(own) == 2:
            both, *alone = smallest(_parted(*own))
            best = [lesser(both, x) for x in alone]
        else:
            best = [smallest([x])[0] for x in own]
        return tuple(_digest(*b[1:]) if b else None for b in best)

    def sample(*texts: str | None) -> tuple[np.ndarray | None, ...]:
        return of_words(*map(hashed, texts))

    sample.hashed, sample.of_words = hashed, of_words
    return sample


def _digest(terms: np.ndarray, t: np.ndarray) -> np.ndarray:
    """16 bits of a hash of (term, t)."""
    mixed = (terms ^ (t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed >> np.uint64(48)).astype(np.uint16)


def to_text(s: np.ndarray | None) -> str:
    return "" if s is None else s.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Share of equal samples: an estimate of generalised Jaccard similarity."""
    if a is None or b is None:
        return 1.0 if a is None and b is None else 0.0
    return float((a == b).mean())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint): hexadecimal, four digits a sample."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = sampler(samples, pairs=True)
        return to_batches(((i, to_text(*one(t))) for i, t in batch_rows(batches)), schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by the first as many (or
    all) of the following text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def edited_words(text: str, own: np.ndarray, following: str, after: np.ndarray, hashed: Callable[[str], np.ndarray]) -> np.ndarray:
    """Hashes of the words of ``edited(text, following)``, from those of both:
    only words at the ends of the two parts are other ones."""
    n = len(text) // 3
    front, back = text[:len(text) - n], following[:n]
    p, q = front.split(), back.split()
    if not p or not q:
        return np.concatenate([own[:max(0, len(p) - 1)], hashed(" ".join(p[-1:])), after[:max(0, len(q) - 1)], hashed(" ".join(q[-1:]))])
    if front[-1].isspace() or back[0].isspace():
        return np.concatenate([own[:len(p) - 1], hashed(p[-1]), after[:len(q) - 1], hashed(q[-1])])
    return np.concatenate([own[:len(p) - 1], hashed(p[-1] + q[0]), after[1:len(q) - 1], hashed(q[-1]) if len(q) > 1 else after[:0]])


def _follow(docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, text, own): documents in buckets of neighbouring ids,
    each bucket also holding (own = false) the first document of the next
    one down; after the last bucket comes the first."""
    spark = docs.sparkSession
    docs = docs.withColumn("rank_id", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    ids = docs.select("rank_id")  # column pruning: no text is read for this
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(4 * max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-size // BUCKET_BYTES))
    found = ids.agg(F.percentile_approx("rank_id", [k / n for k in range(1, n)], 100 * n)).first()[0]
    cuts = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("long")
    def bucket_of(i: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, i.to_numpy()))

    # the first document of each bucket in falling order: one row a bucket
    tops = np.array(sorted((r.top, r.b) for r in ids.groupBy(bucket_of("rank_id").alias("b")).agg(F.max("rank_id").alias("top")).collect()),
                    np.int64).reshape(-1, 2)
    top_ids, shown_to = tops[:, 0], np.roll(tops[:, 1], -1)  # shown to the bucket above; the highest to the lowest

    @F.pandas_udf("long")
    def shown_in(i: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(top_ids, i.to_numpy()), len(top_ids) - 1)
        return pd.Series(np.where(top_ids[at] == i.to_numpy(), shown_to[at], -1))

    bucket, shown = bucket_of("rank_id"), shown_in("rank_id")
    both = docs.withColumn("place", F.array(F.struct(bucket.alias("bucket"), F.lit(True).alias("own")),
                                            F.struct(shown.alias("bucket"), F.lit(False).alias("own"))))
    return both.select(F.explode("place").alias("p"), "rank_id", "doc_id", "text").select("p.bucket", "p.own", "rank_id", "doc_id", "text") \
        .filter(F.col("bucket") >= 0)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next): each document against its text edited with the
    next document in falling order of id, and against that document. Rows of
    one id follow in order of their texts' CRC-32, then of their texts."""
    import hashlib

    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sampler(samples, pairs=True)

        def result(one: tuple, following: tuple):
            _, doc, text, words = one
            new = edited(text, following[2])
            own, changed = sample.of_words(words, edited_words(text, words, following[2], following[3], sample.hashed))
            return own, (doc, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), to_text(own), to_text(changed),
                    likeness(own, changed))

        def rows():
            # a row is complete once the next one's samples are known, those of
            # the bucket's last from the lookahead
            before = waiting = None
            done = None  # the bucket whose lookahead has come
            for bucket, own, doc, text in batch_rows(batches):
                if bucket == done:
                    continue  # further rows of the lookahead's id
                now = (bucket, doc, text or "", sample.hashed(text))
                if before and before[0] == bucket:
                    print_of, row = result(before, now)
                    if waiting:
                        yield (*waiting[1], likeness(waiting[0], print_of))
                    waiting = print_of, row
                    if not own:
                        yield (*row, likeness(print_of, sample.of_words(now[3])[0]))
                if own:
                    before = now
                else:
                    before, waiting, done = None, None, bucket
        return to_batches(rows(), schema)

    placed = _follow(id_and_text(docs, id_col, text_col))
    text = F.coalesce("text", F.lit(""))
    return placed.repartition("bucket").sortWithinPartitions("bucket", F.desc("own"), F.desc("rank_id"), F.crc32(F.encode(text, "UTF-8")), text) \
        .select("bucket", "own", "doc_id", "text").mapInArrow(
            run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
