"""Each registered query on awkward rows, against brute force."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from cases import ascii_lower, documents, groups, plain_fingerprint, plain_words, sha, write
from tokenizers import Tokenizer

from chartwise.llm import fingerprint, langid, queries
from chartwise.llm.oracle import oracle_sql

DOCS = documents()
LABELS = [(k, 0, int(k % 3 == 0)) for k in range(60)] + [(3, 1, None), (None, 0, 1), (5, 0, 1)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write(tmp_path_factory.mktemp("odd"), DOCS, labels=LABELS)


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    return write(tmp_path_factory.mktemp("empty"), [], benchmark=())


def run(spark, name, folder):
    return [r.asDict() for r in queries.queries()[name](spark, folder).collect()]


def key(r):
    return tuple((v is not None, v) for v in r)


def same(got, wanted):
    assert sorted(got, key=key) == sorted(wanted, key=key)


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, empty, name):
    df = queries.queries()[name](spark, empty)
    assert df.columns and df.collect() == []


def test_simhash(spark, folder):
    fps = [plain_fingerprint(d[1]) for d in DOCS]
    root = groups(len(DOCS), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    least = {}
    for k, d in enumerate(DOCS):
        if d[0] is not None:
            least[root[k]] = min(d[0], least.get(root[k], d[0]))
    same([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in run(spark, "op1_simhash", folder)],
         [(d[0], f"{f:016x}", least.get(g)) for d, f, g in zip(DOCS, fps, root, strict=True)])


def test_decontaminate(spark, folder):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = [tuple(r[c] for c in cols) for r in run(spark, "op2_decontaminate", folder)]
    same(got, [tuple(r) for r in con.sql(f"SELECT {', '.join(cols)} FROM ({oracle_sql()['op2_decontaminate']})").fetchall()])
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_language_model(spark, folder):
    tokens = [[*plain_words(d[1]), " "] for d in DOCS]
    c = Counter(t for d, ts in zip(DOCS, tokens, strict=True) if fold(d[0], 5) != 1 for t in ts)
    total, distinct = sum(c.values()), len(c)
    got = run(spark, "op3_lm", folder)
    wanted = [(d[0], fold(d[0], 5) == 1, len(ts), sum(c[t] > 0 for t in ts), total,
               round(sum(math.log10((c[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in ts), 6)) for d, ts in zip(DOCS, tokens, strict=True)]
    same([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got], wanted)
    assert all(-1e9 < r["score"] < 0 for r in got)


def test_bpe(spark, folder):
    lib = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    wanted = []
    for d in DOCS:
        ids = lib.encode(d[1] or "", add_special_tokens=False).ids
        wanted.append((d[0], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids, skip_special_tokens=False).encode())))
    same([(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in run(spark, "op4_bpe", folder)], wanted)


def test_language(spark, folder):
    got = run(spark, "op5_language", folder)
    assert len(got) == len(DOCS)
    texts = defaultdict(set)
    for d in DOCS:
        texts[d[0]].add(bool(d[1]) and any(map(str.isalpha, d[1])))
    for r in got:
        assert 0 <= r["score"] <= 1 and r["held_out"] == (fold(r["doc_id"], 3) == 1)
        if len(texts[r["doc_id"]]) == 1:
            assert (r["lang_pred"] == "und") == (texts[r["doc_id"]] == {False})
    lang = {d[0]: d[2] for d in DOCS if d[0] is not None and d[0] < 60 and d[1].count(" ") > 8}
    own = [r for r in got if r["held_out"] and r["doc_id"] in lang and r["doc_id"] > 1]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in own]) > 0.9


def test_fingerprint(spark, folder):
    ranked = sorted(DOCS, key=lambda d: (-(d[0] if d[0] is not None else -(1 << 63)), zlib.crc32((d[1] or "").encode()), d[1] or ""))
    got = run(spark, "op6_fingerprint", folder)
    wanted = []
    for k, d in enumerate(ranked):
        text, after = d[1] or "", ranked[(k + 1) % len(ranked)][1] or ""
        wanted.append((d[0], len(text), sha(fingerprint.edited(text, after).encode())))
    same([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got], wanted)
    one = fingerprint.sampler()
    prints = {d[0]: fingerprint.to_text(*one(d[1])) for d in DOCS if d[0] not in (None, 0, 1)}
    for r in got:
        if r["doc_id"] in prints:
            assert r["fingerprint"] == prints[r["doc_id"]]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_toxicity(spark, folder):
    got = run(spark, "op7_toxicity", folder)
    same([r["doc_id"] for r in got] and [(r["doc_id"],) for r in got], [(d[0],) for d in DOCS])
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == (fold(r["doc_id"], 5) == 0)


def test_sharding(spark, folder):
    got = run(spark, "op9_sharding", folder)
    same([(r["doc_id"], r["size"], r["text_crc32"]) for r in got],
         [(d[0], len((d[1] or "").encode()) + 16, zlib.crc32((d[1] or "").encode())) for d in DOCS])
    places = defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < 40 and r["law"] == "bytes" and r["grown_shard"] is None
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    shards = defaultdict(set)
    for r in got:
        shards[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_token_files(spark, folder):
    lib = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    start, wanted = 0, []
    for d in sorted(DOCS, key=lambda d: (d[0] is not None, d[0], d[1] is not None, (d[1] or "").encode())):
        ids = np.array([*lib.encode(d[1] or "", add_special_tokens=False).ids, 0], "<u4")
        wanted.append((d[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    same([(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in run(spark, "op10_token_files", folder)], wanted)


def test_language_without_labels(spark, tmp_path):
    docs = write(tmp_path, [(k, "some text here", None, "s", 14) for k in range(4)])
    assert {(r["lang_pred"], r["score"]) for r in run(spark, "op5_language", docs)} == {(langid.UNKNOWN, 0.0)}


def test_lower_casing_is_ascii_only():
    assert ascii_lower("ÄB") == "Äb"
