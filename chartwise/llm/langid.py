"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader (per-coordinate
rates, elastic net), then calibrated by a temperature.

Features are hashed n-grams of 1 to 3 characters of the lower-cased text,
everything but letters counting as a space; log counts times inverse document
frequency, scaled to unit length. Document frequencies come from all learning
rows (counted per task, summed by bucket). The weights are fitted on at most
``MAX_ROWS`` learning rows, equally many per language, a fifth of which only
serve for the temperature; this bound is documented and fixed. Every text is
then scored whole, where it lies.

Defined cases: a text that is null, empty or without a letter is ``und`` with
score 0. Rows without a language aren't learned from; with none to learn from
all rows are ``und``. Rows with a null id are scored. Repeated rows are scored
one by one. Other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwise.llm.common import batch_rows, bounded_rows, held_out, id_and_text, to_batches

BUCKETS = 1 << 15
MAX_ROWS = 6000
EPOCHS = 3
UNKNOWN = "und"
_SLICE = 1 << 18
_ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngram_counts(text: str | None, letters: np.ndarray) -> np.ndarray | None:
    """Counts of the hashed n-grams; None if the text has no letter."""
    counts, any_letter = np.zeros(BUCKETS, np.int64), False
    text = (text or "").lower()
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    for at in range(0, len(text), _SLICE):
        cp = np.frombuffer(text[at:at + _SLICE + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        own = letters[cp]
        any_letter |= bool(own.any())
        cp = np.where(own, cp, np.uint32(32))
        fresh = min(len(cp), _SLICE)  # the next slice starts here; n-grams that start later are its
        h = np.zeros(len(cp), np.uint32)
        for n in range(1, 4):
            if len(cp) < n:
                break
            h = (h[:len(cp) - n + 1] ^ cp[n - 1:]) * np.uint32(_ODD[n - 1])
            h ^= h >> np.uint32(15)
            counts += np.bincount((h * np.uint32(_ODD[2 - n // 2]) >> shift)[:fresh], minlength=BUCKETS)
    return counts if any_letter else None


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of unit length."""
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    return at, x / np.linalg.norm(x)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS, alpha: float = 0.5, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.01) -> np.ndarray:
    """FTRL-proximal over (buckets, values, class); returns weights, classes x
    buckets, the last column being the intercepts."""
    z, n = np.zeros((classes, BUCKETS + 1)), np.zeros((classes, BUCKETS + 1))

    def weights(at):
        zi, ni = z[:, at], n[:, at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        w[np.abs(zi) <= l1] = 0
        return w

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = weights(at)
            p = _softmax(w @ x)
            p[y] -= 1
            g = p[:, None] * x[None, :]
            ni = n[:, at]
            z[:, at] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[:, at] = ni + g * g
    return weights(np.arange(BUCKETS + 1))


def logits(weights: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
    return weights[:, at] @ x + weights[:, -1]


def temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of smallest log loss, by golden-section search."""
    def loss(log_t: float) -> float:
        p = _softmax(scores / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean()

    a, b, r = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(50):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(labelled: DataFrame, max_rows: int = MAX_ROWS) -> dict | None:
    """Model from (doc_id, text, lang) rows; None without any to learn from."""
    spark = labelled.sparkSession
    shared = spark.sparkContext.broadcast({})
    df_schema = pa.schema([("bucket", pa.int32()), ("df", pa.int64())])

    def table():
        if "letters" not in shared.value:
            shared.value["letters"] = letter_table()
        return shared.value["letters"]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS, np.int64), 0
        for (text,) in batch_rows(batches):
            if (c := ngram_counts(text, table())) is not None:
                total += c > 0
                rows += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()), pa.array([rows, *total[at].tolist()], pa.int64())], schema=df_schema)

    learn = labelled.filter(F.col("lang").isNotNull())
    df = np.zeros(BUCKETS)
    n = 0
    for r in learn.select("text").mapInArrow(count, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect():
        if r.bucket < 0:
            n = r.df
        else:
            df[r.bucket] = r.df
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df)) + 1
    chosen = bounded_rows(learn.select("doc_id", "lang").distinct(), "lang", "doc_id", max_rows).select("doc_id").distinct()
    feature_schema = pa.schema([("key", pa.int64()), ("lang", pa.string()), ("at", pa.binary()), ("n", pa.binary())])

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for key, lang, text in batch_rows(batches):
                if (c := ngram_counts(text, table())) is not None:
                    at = np.flatnonzero(c)
                    yield key, lang, at.astype("<u2").tobytes(), np.log1p(c[at]).astype("<f4").tobytes()
        return to_batches(rows(), feature_schema, lambda r: 2 * len(r[2]))

    # at most max_rows ids: a broadcast of proven size; and of each id one row, so as many rows
    sample = learn.join(F.broadcast(chosen), learn["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi") \
        .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("doc_id", F.crc32(F.encode("text", "UTF-8"))).alias("key"), "lang", "text")).alias("row")).select("row.*")
    got = sorted(sample.mapInArrow(features, "key long, lang string, at binary, n binary").toLocalIterator(), key=lambda r: (r.key, r.lang))
    langs = sorted({r.lang for r in got})
    if not got:
        return None
    rows = []
    for r in got:
        at = np.frombuffer(r.at, "<u2").astype(np.int64)
        x = np.frombuffer(r.n, "<f4") * idf[at]
        rows.append((at, x / np.linalg.norm(x), langs.index(r.lang)))
    keep = [k for k in range(len(rows)) if k % 5] or list(range(len(rows)))
    tune = [k for k in range(len(rows)) if k % 5 == 0]
    w = fit([rows[k] for k in keep], len(langs))
    t = temperature(np.stack([logits(w, *rows[k][:2]) for k in tune]), np.array([rows[k][2] for k in tune]))
    return {"langs": langs, "weights": w, "idf": idf, "temperature": t}


def predict(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast({"model": model})
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = scorer(shared.value)
        return to_batches(((i, *one(text)) for i, text in batch_rows(batches)), schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def scorer(state: dict):
    """The function text -> (language, probability). ``state`` keeps what is
    built from the model for the next task of the Python worker."""
    model = state["model"]
    if "letters" not in state:
        state["letters"] = letter_table()
    letters = state["letters"]

    def one(text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text, letters) if model else None
        if counts is None:
            return UNKNOWN, 0.0
        p = _softmax(logits(model["weights"], *tfidf(counts, model["idf"])) / model["temperature"])
        return model["langs"][int(p.argmax())], float(p.max())

    return one


def learning_rows(docs: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """The rows that may be learned from: all whose id isn't in the fold."""
    return docs.filter(~held_out("doc_id", folds, fold)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                                               F.col("lang").cast("string").alias("lang"))


def keep_known(docs: DataFrame, model: dict | None, min_score: float = 0.0, text_col: str = "text") -> DataFrame:
    """``docs`` without those of unknown language or below ``min_score``; without
    a model, without those that have no letter."""
    shared = docs.sparkSession.sparkContext.broadcast({"model": model})
    schema, at = docs.schema, docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, model = scorer(shared.value), shared.value["model"]
        for b in batches:
            texts = (b.column(at)[i].as_py() for i in range(b.num_rows))
            if model is None:
                keep = [any(map(str.isalpha, t or "")) for t in texts]
            else:
                keep = [lang != UNKNOWN and score >= min_score for lang, score in map(one, texts)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
