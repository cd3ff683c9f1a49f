"""Substring dedup, ranked search and phrase mining, against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from cases import ascii_lower, documents, sentence, sha, write
from pyspark.sql import functions as F

from chartwise.llm import phrases, queries, search, substrings
from chartwise.llm.oracle import oracle_sql
from chartwise.llm.words import CHUNK_BYTES, Alphabet, words_of

DOCS = documents()
BENCHMARK = ((1, "the of and that with house river mountain little people water the of and that"), (2, "two words"), (3, None), (4, ""), (5, " -- "),
             (6, DOCS[3][1][:300]), (7, "The the THE water? wasser über élève"), (6, "other words of one id: changed house"), (2, "two words"), (None, "no id"))
SPACE = re.compile("[^\x20\x09-\x0d]+")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def by_text(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write(tmp_path_factory.mktemp("odd"), DOCS, benchmark=BENCHMARK)


def from_sql(folder, name, cols):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return [tuple(r) for r in con.sql(f"SELECT {', '.join(cols)} FROM ({oracle_sql()[name]})").fetchall()]


@pytest.mark.parametrize("name", ["op11_substrings", "op12_search", "op13_phrases"])
def test_queries_against_sql(spark, folder, name):
    df = queries.queries()[name](spark, folder)
    assert by_text(map(tuple, df.collect())) == by_text(from_sql(folder, name, df.columns))


def plain_repeats(rows, n):
    """{place of the row: kept words}, by looking at every window."""
    least = {}
    big = 1 << 63
    words = [SPACE.findall(t or "") for _, t in rows]
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - n + 1):
            key = tuple(w[k:k + n])
            least[key] = min(least.get(key, big), big if i is None else i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - n + 1):
            if least[tuple(w[k:k + n])] < (big if i is None else i):
                gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize(("n", "k", "batch_bytes", "range_bytes"), [(13, 5, 1 << 20, 1 << 20), (13, 5, 1, 900), (13, 5, 3000, 5000), (4, 2, 700, 10_000), (3, 3, 700, 1 << 20), (1, 1, 5000, 5000)])
def test_repeats_in_any_batches(spark, n, k, batch_bytes, range_bytes):
    rng = random.Random(n + k)
    shared = [sentence(rng, "en", 40) for _ in range(3)]
    rows = [(d[0], d[1]) for d in DOCS if len(d[1] or "") < 20_000]
    for i in range(40):  # parts of shared passages amid other words, some cut short, some doubled
        a, b = sorted(rng.sample(range(41), 2))
        part = " ".join(rng.choice(shared).split()[a:b])
        rows.append((rng.choice([400 + i, 400, None]), f"{sentence(rng, 'de', 9)}\t{part}\n {part if i % 3 else ''} {sentence(rng, 'fr', 5)}"))
    got = substrings.find_repeats(frame(spark, rows).repartition(5), n, k, batch_bytes=batch_bytes, range_bytes=range_bytes)
    got = got.select("doc_id", "repeat_words", substrings.n_removed().alias("gone"), "repeat_kept")
    assert by_text(map(tuple, got.collect())) == by_text(plain_repeats(rows, n))


def test_repeats_keep_other_columns_and_name_maximal_runs(spark):
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(1, words, "x"), (2, f"a b {words} c {words}", "y"), (2, f"a b {words} c {words}", "y"), (None, words, None)]
    df = frame(spark, rows, "doc_id long, text string, b string").withColumn("repeat_kept", F.lit(0)).withColumn("payload", F.array(F.lit(1.5)))
    got = substrings.find_repeats(df)
    assert got.columns == ["doc_id", "text", "b", "payload", "repeat_words", "repeat_spans", "repeat_kept"]
    found = {r.b: ([tuple(s) for s in r.repeat_spans], r.repeat_kept, r.payload, r.repeat_words) for r in got.collect()}
    assert found == {"x": ([], words, [1.5], 30), "y": ([(2, 32), (33, 63)], "a b c", [1.5], 63), None: ([(0, 30)], "", [1.5], 30)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("batches_")]


def test_numbers_pack_and_unpack():
    rng = np.random.default_rng(3)
    for v in (np.array([], np.uint64), np.array([7], np.uint64), rng.integers(0, 1 << 63, 1000).astype(np.uint64) * 2, np.array([(1 << 64) - 1, 0, 5], np.uint64)):
        assert (substrings.unpack_ints(substrings.pack_ints(v)) == v).all()
        v = np.sort(v)
        assert (substrings.unpack_sorted(substrings.pack_sorted(v)) == v).all()
    signed = np.array([-5, np.iinfo(np.int64).max, np.iinfo(np.int64).min], np.int64)
    assert (substrings.unpack_ints(substrings.pack_ints(signed), np.int64) == signed).all()
    q = dict(substrings.dealt(np.sort(rng.integers(0, 1 << 63, 500).astype(np.uint64) * 2), 7))
    assert sorted(q) == list(range(7)) and [s.start for s in q.values()][1:] == [s.stop for s in q.values()][:-1]


@pytest.mark.parametrize("size", range(1, 12))
def test_least_of_neighbours(size):
    v = np.array(random.Random(size).sample(range(1000), 40), np.uint64)
    assert substrings.least_of(v, size).tolist() == [min(v[i:i + size].tolist()) for i in range(len(v) - size + 1)]


def test_words_of_a_column():
    texts = ["Ab  c", None, "", "x\ny. z", "é\x85 \x1c", "w" * (CHUNK_BYTES + 9) + " w", "ab", "c,d"] + [" ".join(f"v{k}" for k in range(400_000))]
    column = pa.array(["cut off", *texts])[1:]
    got = words_of(column, Alphabet(b" \t", b".,\n", lower=True))
    raw = got.raw.tobytes()
    wanted = [[p.split(" ") for p in re.split("[.,\n]", t or "")] for t in texts]
    wanted = [(r, w.encode(), (r, k)) for r, ps in enumerate(wanted) for k, p in enumerate(ps) for w in p if w]
    assert [(r, raw[a:b]) for r, a, b in zip(got.row.tolist(), got.starts.tolist(), got.ends.tolist(), strict=True)] == [x[:2] for x in wanted]
    assert got.counts.tolist() == [sum(x[0] == r for x in wanted) for r in range(len(texts))]
    assert (got.piece[1:] == got.piece[:-1]).tolist() == [a[2] == b[2] for a, b in zip(wanted[:-1], wanted[1:], strict=True)]
    numbers = defaultdict(set)
    for (_, w, _), h in zip(wanted, got.hashes.tolist(), strict=True):
        numbers[ascii_lower(w.decode())].add(h)
    assert all(len(x) == 1 for x in numbers.values()) and len(set().union(*numbers.values())) == len(numbers)


def plain_ranks(docs, items, k):
    own = [(i, Counter(TERM.findall(ascii_lower(t)))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in set(items):
        asked = TERM.findall(ascii_lower(text))
        scores = []
        for i, c in own:
            if c:
                m = 25 + 75 * sum(c.values()) * n_docs // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
                if s:
                    scores.append((-s, 1 << 63 if i is None else i, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2])[:k], 1)]
    return out


@pytest.mark.parametrize(("batch_bytes", "block_bytes", "k"), [(1 << 20, 1 << 20, 10), (1, 30, 3), (4000, 100, 500)])
def test_ranks_in_any_batches(spark, batch_bytes, block_bytes, k):
    rows = [(d[0], d[1]) for d in DOCS]
    index = search.build_index(frame(spark, rows).repartition(4), batch_bytes=batch_bytes)
    got = search.search(index, frame(spark, BENCHMARK, "item_id int, text string"), k, block_bytes=block_bytes)
    assert got.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert by_text(map(tuple, got.collect())) == by_text(plain_ranks(rows, BENCHMARK, k))


def test_bounds_cover_every_term():
    rng = np.random.default_rng(1)
    own = [rng.integers(0, 1 << 63, rng.integers(1, 60)).astype(np.uint64) for _ in range(37)]
    bits = search.signature(own, 12 * 64)
    for d, mine in enumerate(own):
        assert search.present(bits, mine, len(own))[:, d].all()
    other = search.present(bits, rng.integers(0, 1 << 63, 400).astype(np.uint64), len(own))
    assert other.mean() < 0.1


def test_search_scores_few_documents(spark):
    """What the bounds exclude is not scored: a rare term's holders come first."""
    rng = random.Random(2)
    texts = pa.array([sentence(rng, "en", 60) + (" zebra" if k % 100 == 7 else "") for k in range(2000)])
    known = {"terms": {b"zebra": 0, b"the": 1}, "docs": 2000, "all_terms": 122_000, "hashes": np.array([search.xxhash.xxh3_64_intdigest(t) for t in (b"zebra", b"the")], np.uint64),
             "exact": [[(0, 4000), (1, 300)]], "queries": [(np.array([0, 1]), np.array([4000.0, 300.0]))]}
    looked = []

    class Texts:
        def __getitem__(self, r):
            looked.append(r)
            return texts[r]

    best = search._Best(known, 10)
    cache = search.Recent(search.xxhash.xxh3_64_intdigest)
    own = [Counter(search.terms(t.as_py())) for t in texts]
    entry = [np.concatenate([search.entries(np.array([cache[t] for t, f in c.items() if f >= least], np.uint64), k) for k, least in enumerate(search.LEVELS)]) for c in own]
    group = {"rows": np.arange(2000, dtype=np.int32).tobytes(), "slices": 12 * 64, "bits": search.signature(entry, 12 * 64).tobytes()}
    best.add(np.arange(2000), Texts(), np.array([sum(c.values()) for c in own]), [group])
    assert len(best.heaps[0]) == 10 and all(-d % 100 == 93 or d % 100 == 7 or own[-d][b"zebra"] for _, d in best.heaps[0])
    assert len(looked) < 200


def plain_phrases(docs, least, most, cover, top):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", ascii_lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            counts[lang].update(tuple(w[i:i + k]) for i in range(len(w)) for k in range(1, most + 1) if i + k <= len(w))
    out = []
    for lang, f in counts.items():
        able = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in able.items():
            if any(100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in able.items() if len(q) > len(p)):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), " ".join(p), a, f[p[:k]], f[p[k:]], n[lang], score))
        out += [(lang, r, *x[3:]) for r, x in enumerate(sorted(rows)[:top], 1)]
    return out


@pytest.mark.parametrize(("least", "most", "batch_bytes", "range_bytes", "top"), [(30, 4, 1 << 20, 1 << 20, 2000), (3, 4, 2000, 3000, 50), (2, 3, 1, 2000, 2000), (5, 2, 1, 1 << 20, 7), (2, 5, 5000, 900, 2000)])
def test_phrases_in_any_batches(spark, least, most, batch_bytes, range_bytes, top):
    rng = random.Random(least)
    docs = [(d[2], d[1]) for d in DOCS if len(d[1] or "") < 9000]
    docs += [(rng.choice(["en", None, "und", "x\ty\nz"]), f"Fixed phrase of words{rng.choice(['.', ' ', chr(9), chr(13), '; '])}here and THERE\x00 \x1cand\x85 {sentence(rng, 'en', 6)}!") for _ in range(200)]
    got = phrases.collocations(frame(spark, docs, "lang string, text string").repartition(4), least, most, 80, top, batch_bytes=batch_bytes, range_bytes=range_bytes)
    wanted = plain_phrases(docs, least, most, 80, top)
    assert len(wanted) > 5 and by_text(map(tuple, got.collect())) == by_text(wanted)


def test_quicksort_counts_prefixes():
    rng = random.Random(8)
    rows = [[rng.randint(0, 3) for _ in range(rng.randint(1, 5))] for _ in range(300)]
    symbols = np.full((5, len(rows)), -1)
    for i, r in enumerate(rows):
        symbols[:len(r), i] = r
    weights = np.array([rng.randint(1, 9) for _ in rows])
    wanted = Counter()
    for r, w in zip(rows, weights.tolist(), strict=True):
        wanted.update({tuple(r[:k]): w for k in range(1, len(r) + 1)})
    got = {tuple(rows[at][:depth]): count for at, depth, count in phrases.sorted_counts(symbols, weights, 40, 3)}
    assert got == {p: c for p, c in wanted.items() if len(p) <= 3 or c >= 40}


def test_digest_of_kept_words(spark, folder):
    got = {r.doc_id: r.kept_sha256 for r in queries.op11_substrings(spark, folder).collect() if r.doc_id in (100, 101)}
    assert got[101] == sha(b"") and got[100] == sha(" ".join(DOCS[60][1].split()).encode())


def test_learning_rows_are_bounded_whatever_ids_repeat(spark):
    """Rows of one id speak once, so no more rows are fetched than chosen."""
    from chartwise.llm import langid, toxicity
    rng = random.Random(9)
    rows = [(k % 40 if k % 50 else None, sentence(rng, ("en", "de")[k % 2], 12), ("en", "de")[k % 2]) for k in range(4000)]
    docs = frame(spark, rows, "doc_id long, text string, lang string")
    seen = []
    fit = langid.fit
    langid.fit = lambda data, n: (seen.append(len(data)), fit(data, n))[1]
    try:
        assert langid.train(docs, max_rows=30)["langs"] == ["de", "en"]
    finally:
        langid.fit = fit
    assert 0 < seen[0] <= 30
    labels = frame(spark, [(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    assert toxicity.train(docs.select("doc_id", "text"), labels, max_rows=30)["prior"] > 0


def test_other_tokenizer_files_take_the_librarys_way(tmp_path):
    import json

    from tokenizers import Tokenizer

    from chartwise.llm import bpe, tokenfile
    from chartwise.llm.queries import tokenizer_path
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}']+|[^\s\p{L}\p{N}]+"
    path = str(tmp_path / "words.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    texts = ["Don't stop 12 34a!", "two  words", "", "x1y2 it's"]
    one, lib = bpe.encoder(bpe.load(path)), Tokenizer.from_file(path)
    assert [np.frombuffer(one(t), "<u4").tolist() for t in texts] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    for front in (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}):
        text = json.dumps(spec | {"pre_tokenizer": front})
        lib = Tokenizer.from_str(text)
        got = [np.frombuffer(tokenfile.chunk_encoder(text, "<u4")(t), "<u4").tolist() for t in texts]
        assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_of_a_batch_share_their_look_ups(monkeypatch):
    """Ids as the library gives them, and a part that stands in many texts is looked up once."""
    from tokenizers import Tokenizer

    from chartwise.llm import tokenfile
    from chartwise.llm.queries import tokenizer_path
    asked = Counter()

    class Counted(tokenfile.Short):
        def __getitem__(self, key):
            asked[key] += 1
            return super().__getitem__(key)

    monkeypatch.setattr(tokenfile, "Short", Counted)
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    lib = Tokenizer.from_str(spec)
    many = tokenfile.encoders(spec, "<u2")[1]
    texts = ["Word other, word's 12 a12b.", "Word other,%% Ünï× é.é\n\nother other", "a other"] * 20
    odd = ["", " ", "\n", " a", "a ", "a\n b", "a\n\n\nb", "a  b", "a\tb", "a\xa0b\x1cc", "it's 'so", "fooā.x", "a<|endoftext|>b", "x" * 99 + ".", "é. —."]
    got = [np.frombuffer(raw, "<u2").tolist() for raw in many(texts + odd)]
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts + odd]
    assert asked[" other"] == 1
