"""LM scoring by a log-bilinear model trained with noise-contrastive estimation.

Tokens fall into classes: each of the most frequent words has its own, all
others share classes by the last bytes of the word, and the end of a text has
one. The model predicts the class of a token from the classes of the two before
it (a vector for each context class, weighted by position, times a vector of
the predicted class, plus a bias); within a shared class a word has its
smoothed relative frequency. So every word, known or not, has a probability,
and they sum to one.

Counting, fitting and scoring all run over whole texts where they lie:

1. word counts of all learning rows (summed per task before the shuffle);
2. fitting in numpy: a short start on at most ``WARM_DOCS`` rows, then every
   partition of the learning rows takes stochastic steps from there, and the
   partitions' weights are averaged by tokens, with a groupBy;
3. scoring: as contexts are pairs of classes, two batched matrix products give
   the scores of all context and target classes, and a third the normaliser of
   every pair of contexts, once; a token's log probability is then three
   table look-ups.

The broadcast tables are bounded by ``HEAD`` words. Words beyond these are
joined to their counts by a shuffle, so no count is cut.

Defined cases: a null or blank text is just its end token. With nothing to
learn from (no rows), all words are unknown and the score is the base score.
Rows with a null id are scored, repeated rows one by one, and other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwise.llm.common import batch_rows, id_and_text, materialise, to_batches

HEAD = 1 << 17
OWN, SHARED = 767, 256
SIZE, NOISE, BATCH = 24, 48, 4096
WARM_DOCS = 600
RATE = 0.1
END = b" "  # no word holds a space
_FLUSH = 300_000


def words_of(text: str | None) -> list[bytes]:
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and \x20 \x09-\x0D
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shared_class(word: bytes) -> int:
    """The number, from 0, of the class that a word without one of its own is in."""
    return zlib.crc32(word[-3:]) % SHARED


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, shared, n) over the texts of ``rows``, the ends of texts included."""
    schema = pa.schema([("word", pa.binary()), ("shared", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            seen: Counter = Counter()
            for (text,) in batch_rows(batches):
                seen.update(words_of(text))
                seen[END] += 1
                if len(seen) > _FLUSH:
                    yield from ((w, shared_class(w), n) for w, n in seen.items())
                    seen.clear()
            yield from ((w, shared_class(w), n) for w, n in seen.items())
        return to_batches(out(), schema)

    return rows.select("text").mapInArrow(run, "word binary, shared int, n long") \
        .groupBy("word", "shared").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, head: int = HEAD) -> dict | None:
    """Totals, the most frequent words, and the mass of each shared class."""
    by_count = sorted(((r.n, r.k) for r in counts.groupBy("n").agg(F.count("*").alias("k")).filter(F.col("n") > 1).toLocalIterator()), reverse=True)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    if not total:
        return None
    least, held = 1, 0  # words with more than ``least`` go into the head
    for n, k in by_count:
        if held + k > head:
            least = n
            break
        held += k
    else:
        least = 0 if distinct <= head else 1
    top = counts.filter((F.col("n") > least) & (F.col("word") != F.lit(END))).select("word", "n").collect()
    top = sorted(((-r.n, bytes(r.word)) for r in top))
    own = top[:OWN]
    mass = np.full(SHARED, 0.5)  # the unknown word of each class
    tokens = np.zeros(SHARED)
    # sums over all words, without those that have a class of their own
    for r in counts.filter(F.col("word") != F.lit(END)).groupBy("shared").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect():
        mass[r.shared] += r.n + 0.5 * r.k
        tokens[r.shared] += r.n
    for minus, w in own:
        mass[shared_class(w)] -= 0.5 - minus
        tokens[shared_class(w)] += minus
    ends = counts.filter(F.col("word") == F.lit(END)).first()
    n_end = ends.n if ends else 0
    freq = np.concatenate([[n_end], [-m for m, _ in own], np.zeros(OWN - len(own)), tokens]) + 0.5
    words = [w for _, w in top]
    return {"index": {w: k for k, w in enumerate(words)},
            "class": np.array([1 + k if k < OWN else 1 + OWN + shared_class(w) for k, w in enumerate(words)], np.int32),
            "count": np.array([-m for m, _ in top], np.float64), "mass": mass, "noise": freq / freq.sum(), "total": total, "distinct": distinct, "n_end": n_end}


def classes(words: list[bytes], voc: dict) -> tuple[np.ndarray, np.ndarray]:
    """(index in the head or -1, class) of each word."""
    get = voc["index"].get
    at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
    out = np.where(at >= 0, voc["class"][at], 0) if len(voc["class"]) else np.zeros(len(words), np.int32)
    for k in np.flatnonzero(at < 0).tolist():
        out[k] = 1 + OWN + shared_class(words[k])
    return at, out


def start_weights(voc: dict, size: int = SIZE) -> dict:
    n = 1 + OWN + SHARED
    rng = np.random.default_rng(11)
    return {"context": rng.normal(0, 0.1, (n, size)).astype(np.float32), "target": rng.normal(0, 0.1, (n, size)).astype(np.float32),
            "bias": np.log(voc["noise"]).astype(np.float32), "position": np.array([[1.0] * size, [0.6] * size], np.float32)}


def _sum_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows summed by number, into an array of n rows."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    order = np.argsort(at, kind="stable")
    ranked = at[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    out[ranked[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


class _Steps:
    """Adaptive-gradient steps on the NCE objective."""

    def __init__(self, weights: dict, noise: np.ndarray, seed: int, rate: float = RATE):
        self.w = {k: v.astype(np.float32, copy=True) for k, v in weights.items()}
        self.sums = {k: np.full_like(v, 0.1) for k, v in self.w.items()}
        self.edges = np.cumsum(noise)
        self.log_noise = np.log(noise * NOISE).astype(np.float32)
        self.rng, self.rate = np.random.default_rng(seed), rate

    def step(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> None:
        R, Q, b, C = (self.w[k] for k in ("context", "target", "bias", "position"))
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), len(b) - 1)
        r1, r2, q, qn = R[c1], R[c2], Q[w], Q[noise]
        h = r1 * C[0] + r2 * C[1]
        up = 1 / (1 + np.exp(np.clip((h * q).sum(1) + b[w] - self.log_noise[w], -30, 30)))
        down = 1 / (1 + np.exp(-np.clip(h @ qn.T + b[noise] - self.log_noise[noise], -30, 30)))
        dh = up[:, None] * q - down @ qn
        n = len(b)
        both = np.concatenate([w, noise])
        g = _sum_rows(both, np.concatenate([np.column_stack([up[:, None] * h, up]), np.column_stack([-down.T @ h, -down.sum(0)])]).astype(np.float32), n)
        grads = {"target": g[:, :-1], "bias": g[:, -1], "position": np.stack([(dh * r1).sum(0), (dh * r2).sum(0)]),
                 "context": _sum_rows(np.concatenate([c1, c2]), np.concatenate([dh * C[0], dh * C[1]]), n)}
        for k, d in grads.items():
            d = d / len(w) * 64  # of a usual size whatever the batch
            self.sums[k] += d * d
            self.w[k] += self.rate * d / np.sqrt(self.sums[k])


def _examples(texts: Iterable[str | None], voc: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of (class before, class before that, class)."""
    held, n = [], 0
    for text in texts:
        c = np.concatenate([[0, 0], classes(words_of(text), voc)[1], [0]]).astype(np.int64)
        held.append(np.stack([c[1:-1], c[:-2], c[2:]]))
        n += len(c) - 2
        if n >= BATCH:
            some = np.concatenate(held, axis=1)
            cut = n // BATCH * BATCH
            for k in range(0, cut, BATCH):
                yield tuple(some[:, k:k + BATCH])
            held, n = [some[:, cut:]], n - cut
    if n:
        yield tuple(np.concatenate(held, axis=1))


def _trained(rows: DataFrame, voc, start: dict, size: int = SIZE) -> dict:
    """Steps from ``start`` in each partition of ``rows``; the weights averaged
    by the number of tokens."""
    width = size + 1
    schema = pa.schema([("row", pa.int32()), ("tokens", pa.int64()), ("x", pa.list_(pa.float32()))])
    given = rows.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, tokens = _Steps(given.value, voc.value["noise"], 5), 0
        for c1, c2, w in _examples((t for (t,) in batch_rows(batches)), voc.value):
            steps.step(c1, c2, w)
            tokens += len(w)
        if not tokens:
            return iter(())
        m = steps.w
        table = np.concatenate([np.column_stack([m["context"], np.zeros(len(m["bias"]))]), np.column_stack([m["target"], m["bias"]]),
                                np.column_stack([m["position"], np.zeros(2)])])
        return to_batches(((k, tokens, x.tolist()) for k, x in enumerate(table)), schema)

    sent = rows.select("text").mapInArrow(run, "row int, tokens long, x array<float>")
    means = sent.groupBy("row").agg(*[(F.sum(F.col("x")[k] * F.col("tokens")) / F.sum("tokens")).alias(f"x{k}") for k in range(width)]).collect()
    if not means:
        return start
    table = np.array([list(r)[1:] for r in sorted(means)], np.float32)
    n = len(start["bias"])
    return {"context": table[:n, :-1], "target": table[n:2 * n, :-1], "bias": table[n:2 * n, -1], "position": table[2 * n:, :-1]}


def fit(rows: DataFrame, voc: dict, warm_docs: int = WARM_DOCS) -> dict:
    """Weights from the (doc_id, text) rows. The start is on the ``warm_docs``
    rows of smallest hash, in one task; then all rows are learned from."""
    shared = rows.sparkSession.sparkContext.broadcast({k: voc[k] for k in ("index", "class", "noise")})
    n = max(1, rows.select("doc_id").count())
    share = F.pmod(F.xxhash64("doc_id", F.lit("warm")), F.lit(1 << 40))
    warm = rows.filter(share <= F.lit(min(1.0, 1.2 * warm_docs / n) * (1 << 40))).orderBy(share, "doc_id").limit(warm_docs).coalesce(1)
    return _trained(rows, shared, _trained(warm, shared, start_weights(voc)))


def score_tables(weights: dict) -> dict:
    """log10 tables by batched matrix products: score of each (class before,
    class), of each (class before that, class), and the normaliser of each
    (class before, class before that)."""
    R, Q, C = (weights[k].astype(np.float64) for k in ("context", "target", "position"))
    near = (R * C[0]) @ Q.T + weights["bias"]
    far = (R * C[1]) @ Q.T
    top_n, top_f = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
    z = np.log(np.exp(near - top_n) @ np.exp(far - top_f).T) + top_n + top_f.T
    return {k: (v / np.log(10)).astype(np.float32) for k, v in (("near", near), ("far", far), ("z", z))}


def score(docs: DataFrame, learn: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each
    row of ``docs``, learned from the (doc_id, text) rows ``learn``."""
    spark = docs.sparkSession
    counts = materialise(word_counts(learn), "lm-counts")
    voc = vocabulary(counts)
    if voc is None:
        voc = {"index": {}, "class": np.empty(0, np.int32), "count": np.empty(0), "mass": np.full(SHARED, 0.5), "total": 0, "distinct": 0, "n_end": 0}
        tables = None
    else:
        tables = score_tables(fit(learn, voc))
    model = spark.sparkContext.broadcast({k: voc[k] for k in ("index", "class", "count", "mass", "n_end")} | {"tables": tables})
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("model", pa.float64()),
                        ("rest", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        t = m["tables"]
        logs, log_mass = np.log10(m["count"] + 0.5), np.log10(m["mass"])
        end_log = float(np.log10(m["n_end"] + 0.5))

        def rows():
            for i, text in batch_rows(batches):
                words = words_of(text)
                at, cls = classes(words, m)
                in_head = at >= 0
                c = np.concatenate([[0, 0], cls, [0]]).astype(np.int64)
                known = int(in_head.sum()) + (m["n_end"] > 0)
                own_logs = logs[at[in_head]] if len(logs) else np.empty(0)
                s = 0.0
                if t:
                    c1, c2, w = c[1:-1], c[:-2], c[2:]
                    s = float(t["near"][c1, w].sum(dtype=np.float64) + t["far"][c2, w].sum(dtype=np.float64) - t["z"][c1, c2].sum(dtype=np.float64))
                    inside = cls > OWN  # in a shared class
                    s += float(logs[at[in_head & inside]].sum() - log_mass[cls[inside] - 1 - OWN].sum())
                rest = Counter(words[k] for k in np.flatnonzero(~in_head).tolist())
                yield (i, len(words) + 1, known, float(own_logs.sum()) + end_log, s, [{"word": w, "n": n} for w, n in rest.items()])
        return to_batches(rows(), schema, lambda r: 60 * len(r[5]))

    scanned = id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, known long, logs double, model double, rest array<struct<word:binary,n:bigint>>")
    # a number for each row, fixed by writing it: ids can be null or repeated
    scanned = materialise(scanned.withColumn("row", F.monotonically_increasing_id()), "lm-scan")
    rest = scanned.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n")
    found = rest.join(counts.select("word", F.col("n").alias("c")), "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = found.groupBy("row").agg(F.sum(F.col("n") * F.log10(c + 0.5)).alias("rest_logs"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rest_known"))
    total = float(np.log10(voc["total"] + 0.5 * (voc["distinct"] + 1)))
    out = scanned.drop("rest").join(sums, "row", "left")
    rest_logs = F.coalesce("rest_logs", F.lit(0.0))
    base = F.col("logs") + rest_logs - F.col("n_tokens") * F.lit(total)
    return out.select("doc_id", "n_tokens", (F.col("known") + F.coalesce("rest_known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(int(voc["total"])).cast("long").alias("train_tokens"), base.alias("base_score"),
                      (F.col("model") + rest_logs if tables else base).alias("score"))
