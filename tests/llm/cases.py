"""Small handmade tables with every awkward case, and plain brute-force
versions of the operators."""

import hashlib
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import xxhash

WORDS = {"en": "the of and that with house river mountain little people water".split(),
         "de": "der die und nicht häuser größe straße wasser über schön zwischen".split(),
         "fr": "le la les été forêt garçon élève être très où déjà".split()}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "s", "er", "ing", str(rng.randint(0, 9))]) for _ in range(n))


def documents(seed=5, n=60):
    """(doc_id, text, lang, source, n_chars): texts of all sorts."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rng.choice(list(WORDS))
        text = "\n".join(sentence(rng, lang, rng.randint(3, 40)) for _ in range(rng.randint(1, 6)))
        rows.append((k, text, lang, "s"))
    base = sentence(rng, "en", 300)
    rows += [(100 + k, base, "en", "s") for k in range(4)]  # copies
    words = base.split()
    for k in range(6):  # near copies
        w = list(words)
        w[rng.randrange(len(w))] = "changed"
        rows.append((110 + k, " ".join(w), "en", "s"))
    rows += [(200, None, "en", "s"), (201, "", None, "s"), (202, " \t\n ", "de", None), (203, "12 34 -- ??", None, "s"), (204, "A", "en", "s"),
             (205, "two words", "en", "s"), (206, "ÄÖÜ ß İ ﬁ é 日本語テキスト 🙂 \x1c\x85　x", "de", "s"),
             (207, "<|endoftext|>in <|startoftext|>text<|endoftext|>", "en", "s"), (None, "no id at all", "en", "s"), (None, None, None, None),
             (208, "x" * 5000, "en", "s"), (209, sentence(rng, "fr", 6000), "fr", "s"),
             (0, rows[0][1], "en", "other"), (1, "another text of the same id", "en", "s")]  # repeated rows and ids
    rows += [(300 + k, f"{sentence(rng, 'en', 12)}\n{line}", "en", "s") for k, line in enumerate(
        ["all rights reserved by the house of the river people and the little mountain water company in the year 1999"] * 3
        + ["All rights reserved, by the house of the river people and the little mountain water company in the year 2004!"])]
    return [(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows]


def write(folder, docs, benchmark=((1, "the of and that with house river mountain little people water the of and that"), (2, "two words"),
                                   (3, None), (4, ""), (1, "the of and that with house river mountain little people water the of and that")), labels=()):
    """The three tables, with further columns of names that operators use."""
    kinds = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()}
    cols = list(zip(*docs, strict=True)) or [()] * 5
    table = pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds.items(), cols, strict=True)})
    for name in ("row", "key", "fp", "part", "bucket", "size", "items", "word", "n", "id", "place", "label", "_doc", "_version", "_gone", "hit_words", "_hit_spans", "gone"):
        table = table.append_column(name, pa.array(["x"] * len(table), pa.string()))
    pq.write_table(table, f"{folder}/documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([b[0] for b in benchmark], pa.int64()), "text": pa.array([b[1] for b in benchmark], pa.string())}),
                   f"{folder}/benchmark.parquet")
    pq.write_table(pa.table({n: pa.array([x[k] for x in labels], t) for k, (n, t) in enumerate(
        (("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())))}), f"{folder}/labels.parquet")
    return str(folder)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall("[^\x20\x09-\x0d]+", ascii_lower(text))


def plain_fingerprint(text, width=3):
    w = plain_words(text)
    grams = [" ".join(w[k:k + width]) for k in range(max(1, len(w) - width + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    """The smallest member reachable, of each of n things."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def sha(data):
    return hashlib.sha256(data).hexdigest()
