"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

The labelled rows to learn from are bounded: at most ``MAX_ROWS``, by class,
chosen by a hash of the id. Half of them give the lexicon: word beginnings of
4 to 9 characters and whole words that stand in toxic texts far more often than
in others (log odds in standard errors). A third trains the trees, and the
rest, weighted back to the classes' true sizes, the isotonic map from tree
score to probability. All features are counted over whole texts: densities of
lexicon words by strength, how near they stand to a second person, capitals,
punctuation, and obfuscated spellings. Every text is scored where it lies.

Defined cases: null, empty and blank texts have all-zero features and get the
score of these. Labels that are null don't count; a document with several
labels is toxic if one says so. Without both labels to learn from every score is
the share of toxic labels (0 without labels). Rows with null ids are scored
and never learned from. Repeated rows are scored one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwise.llm.common import batch_rows, bounded_rows, held_out, id_and_text, to_batches

MAX_ROWS = 24_000
LEXICON = 3000
_BEGINNINGS = range(4, 10)
_MIN_Z, _MIN_ODDS, _MIN_DOCS = 4.0, 1.0, 6
_STRONG = (1.0, 2.0, 3.0)
_NEAR = 5
#: Words of address in the languages met here.
SECOND_PERSON = ("you", "your", "yours", "u", "ur", "du", "dich", "dir", "dein", "ihr", "euch", "tu", "te", "toi", "vous", "votre", "ton", "ti",
                 "usted", "ustedes", "vosotros")
_LETTERS = re.compile(r"[^\W\d_]+")
_OBFUSCATED = re.compile(r"[^\W\d_]+[@$!*0-9_.\-]+[^\W\d_]+")
_PLAIN_FORM = str.maketrans({"@": "a", "$": "s", "0": "o", "1": "i", "!": "i", "3": "e", "5": "s", "7": "t", "4": "a"})
FEATURES = 16


def entries(word: str) -> list[str]:
    """The lexicon entries that a word could match: its beginnings, itself."""
    return [*(word[:k] for k in _BEGINNINGS if len(word) >= k), word + "$"]


def _strength(word: str, lexicon: dict[str, float], starts: set[str]) -> float:
    if word[:4] not in starts:
        return 0.0
    return max(lexicon.get(e, 0.0) for e in entries(word))


def features(text: str | None, lexicon: dict[str, float], starts: set[str]) -> list[float]:
    text = text or ""
    raw = _LETTERS.findall(text)
    if not raw:
        return [0.0] * FEATURES
    words = [w.lower() for w in raw]
    hits, you = [], []
    for k, w in enumerate(words):
        if w[:4] in starts and (s := _strength(w, lexicon, starts)) > 0:
            hits.append((k, s))
        if w in _YOU:
            you.append(k)
    n = len(words)
    strengths = np.array([s for _, s in hits])
    near = 0
    if hits and you:
        at, to = np.array([k for k, _ in hits]), np.array(you)
        j = np.searchsorted(to, at)
        gap = np.minimum(np.abs(at - to[np.minimum(j, len(to) - 1)]), np.abs(at - to[np.maximum(j - 1, 0)]))
        near = int((gap <= _NEAR).sum())
    hidden = _OBFUSCATED.findall(text)
    unmasked = sum(any(_strength(v, lexicon, starts) > 0 for v in (m.lower().translate(_PLAIN_FORM), re.sub(r"\W|[\d_]", "", m.lower()))) for m in hidden)
    letters = sum(map(len, raw))
    upper = sum(map(str.isupper, text))
    out = [np.log1p(n), np.log1p(len(hits)), len(hits) / n, strengths.sum() / n, strengths.max() if hits else 0.0,
           *[np.log1p((strengths >= t).sum()) for t in _STRONG], (strengths >= _STRONG[1]).sum() / n if hits else 0.0,
           len({words[k] for k, _ in hits}) / n, near / n, np.log1p(near), upper / letters,
           sum(w.isupper() and len(w) > 1 for w in raw) / n, (text.count("!") + text.count("?")) / n, (len(hidden) + 10 * unmasked) / n]
    return [float(x) for x in out]


_YOU = frozenset(SECOND_PERSON)


def learn_lexicon(pairs: Iterable[tuple[str, int, int]], toxic: int, clean: int, most: int = LEXICON) -> dict[str, float]:
    """Log odds of the entries (entry, toxic texts, clean texts) that stand out."""
    found = []
    for e, p, q in pairs:
        if p < _MIN_DOCS:
            continue
        odds = np.log((p + 0.5) / (toxic + 1)) - np.log((q + 0.5) / (clean + 1))
        z = odds / np.sqrt(1 / (p + 0.5) + 1 / (q + 0.5))
        if z >= _MIN_Z and odds >= _MIN_ODDS:
            found.append((-z, e, float(odds)))
    return {e: odds for _, e, odds in sorted(found)[:most]}


class _Trees:
    """Histogram gradient boosting for the logistic loss, as plain arrays."""

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 64,
            least: float = 15.0, l2: float = 1.0) -> dict:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
        p0 = float(np.clip((y * weight).sum() / weight.sum(), 1e-4, 1 - 1e-4))
        base = float(np.log(p0 / (1 - p0)))
        score, grown = np.full(len(y), base), []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = (p - y) * weight, p * (1 - p) * weight
            node = np.zeros(len(y), np.int64)
            feature, cut = np.full(2 ** depth - 1, -1), np.zeros(2 ** depth - 1)
            for level in range(depth):
                for k in range(2 ** level - 1, 2 ** (level + 1) - 1):
                    rows = np.flatnonzero(node == k)
                    best = (1e-6, -1, 0)
                    if len(rows):
                        gs, hs = g[rows].sum(), h[rows].sum()
                        for f, c in enumerate(cuts):
                            if not len(c):
                                continue
                            b = binned[rows, f]
                            gl = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
                            hl = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
                            nl = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                            gain = gl ** 2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs ** 2 / (hs + l2)
                            gain[(nl < least) | (len(rows) - nl < least)] = 0
                            if gain.max() > best[0]:
                                best = (gain.max(), f, int(gain.argmax()))
                    if best[1] >= 0:
                        feature[k], cut[k] = best[1], cuts[best[1]][best[2]]
                    if len(rows):
                        right = x[rows, best[1]] > cut[k] if best[1] >= 0 else np.zeros(len(rows), bool)
                        node[rows] = 2 * k + 1 + right
            leaf = node - (2 ** depth - 1)
            value = -np.bincount(leaf, g, 2 ** depth) / (np.bincount(leaf, h, 2 ** depth) + l2) * rate
            score += value[leaf]
            grown.append((feature, cut, value))
        return {"base": base, "feature": np.stack([t[0] for t in grown]), "cut": np.stack([t[1] for t in grown]),
                "value": np.stack([t[2] for t in grown]), "depth": depth}

    @staticmethod
    def score(model: dict, x: np.ndarray) -> np.ndarray:
        """Log odds of the rows of x."""
        trees = np.arange(len(model["feature"]))
        node = np.zeros((len(x), len(trees)), np.int64)
        for _ in range(model["depth"]):
            f = model["feature"][trees, node]
            right = (np.take_along_axis(x, np.maximum(f, 0), axis=1) > model["cut"][trees, node]) & (f >= 0)
            node = 2 * node + 1 + right
        return model["base"] + model["value"][trees, node - (2 ** model["depth"] - 1)].sum(axis=1)


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: (scores, probabilities), to interpolate between."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # weight, weighted label, weighted score
    for s, t, w in zip(score[order], y[order], weight[order], strict=True):
        blocks.append([w, w * t, w * s])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, max_rows: int = MAX_ROWS) -> dict:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic),
    without the rows whose id is in the held-out fold."""
    one_each = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id", folds, fold)) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = bounded_rows(one_each, "toxic", "doc_id", max_rows)
    # at most max_rows ids: a broadcast of proven size; and of each id one text, so as many rows
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "of_class") \
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row")).select("doc_id", "toxic", "of_class", "row.text") \
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(20)))
    first = rows.filter(F.col("part") < 10)
    schema = pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for toxic, text in batch_rows(batches):
            found = {e for w in {x.lower() for x in _LETTERS.findall(text or "")} for e in entries(w)}
            seen[toxic != 1].update(found)
            seen[toxic != 1][""] += 1
        return to_batches(((e, seen[0][e], seen[1][e]) for e in seen[0].keys() | seen[1].keys()), schema)

    # equal texts speak once
    texts = first.groupBy("toxic", "text").agg(F.lit(1)).select("toxic", "text")
    sums = texts.mapInArrow(count, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    kept = sums.filter((F.col("toxic") >= _MIN_DOCS) & (F.col("toxic") * 1.0 > F.col("clean") * 0.02)).collect()
    totals = next(((r.toxic, r.clean) for r in kept if r.entry == ""), (0, 0))
    lexicon = learn_lexicon(((r.entry, r.toxic, r.clean) for r in kept if r.entry), *totals)
    starts = _starts(lexicon)
    fields = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("of_class", pa.int64()), ("part", pa.int64()), ("x", pa.list_(pa.float64()))])

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return to_batches(((i, toxic, n, part, features(text, lexicon, starts)) for i, toxic, n, part, text in batch_rows(batches)), fields)

    got = rows.filter(F.col("part") >= 10).select("doc_id", "toxic", "of_class", "part", "text") \
        .mapInArrow(measure, "doc_id long, toxic int, of_class long, part long, x array<double>").collect()
    got.sort(key=lambda r: (r.doc_id, r.toxic, r.x))
    share = {r.toxic: r["count"] for r in one_each.groupBy("toxic").count().collect()}
    prior = share.get(1, 0) / max(1, sum(share.values()))
    if len({r.toxic for r in got if r.part >= 16}) < 2 or len({r.toxic for r in got if r.part < 16}) < 2:
        return {"lexicon": lexicon, "trees": None, "prior": prior}
    sampled = Counter(r.toxic for r in got)
    data = [(np.array([r.x for r in some]), np.array([r.toxic for r in some], float), np.array([r.of_class / sampled[r.toxic] for r in some]))
            for some in ([r for r in got if r.part < 16], [r for r in got if r.part >= 16])]
    (x, y, w), (cx, cy, cw) = data
    trees = _Trees.fit(x, y, w / w.mean())
    at, p = isotonic(_Trees.score(trees, cx), cy, cw)
    return {"lexicon": lexicon, "trees": trees, "at": at, "p": p, "prior": prior}


def _starts(lexicon: dict[str, float]) -> set[str]:
    return {e.rstrip("$")[:4] for e in lexicon}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        starts = _starts(m["lexicon"])
        for b in batches:
            ids = b.column(0)
            if m["trees"]:
                x = np.array([features(b.column(1)[i].as_py(), m["lexicon"], starts) for i in range(b.num_rows)]).reshape(-1, FEATURES)
                score = np.interp(_Trees.score(m["trees"], x), m["at"], m["p"]) if len(x) else []
            else:
                score = [m["prior"]] * b.num_rows
            yield pa.RecordBatch.from_arrays([ids, pa.array(score, pa.float64())], schema=schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
