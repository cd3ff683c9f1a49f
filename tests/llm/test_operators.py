"""The operators' own interfaces and inner parts, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from cases import documents, groups, levenshtein, plain_fingerprint, sentence, write
from pyspark.sql import functions as F

from chartwise.llm import bpe, decontaminate, fingerprint, langid, lines, lm, sharding, simhash, tokenfile, toxicity
from chartwise.llm.graph import components
from chartwise.llm.queries import tokenizer_path


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_index_keys_miss_no_pair(distance):
    keys = simhash.key_positions(distance)
    rng = random.Random(distance)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), distance):
            b ^= 1 << k
        assert any(all((a >> 8 * p & 255) == (b >> 8 * p & 255) for p in positions) for positions in keys)


def test_links_in_a_long_list_by_both_ways(spark):
    """A posting list that is too long is split by one more byte, and a list
    of any length can be searched by flipped bits: the same groups."""
    rng = random.Random(4)
    base = rng.getrandbits(64)
    fps = set()
    for _ in range(150):
        x = base
        for k in rng.sample(range(64), rng.randint(0, 6)):
            x ^= 1 << k
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    wanted = groups(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    for limit in (1 << 16, 5):
        links = {(r.u, r.v) for r in simhash.near_links(frame(spark, [(s,) for s in signed], "fp long"), 3, list_rows=limit).collect()}
        linked = {(signed.index(u), signed.index(v)) for u, v in links}
        assert groups(len(fps), lambda i, j, s=linked: (i, j) in s or (j, i) in s) == wanted
    own = np.array([base ^ (x << 24) ^ y for x in (1, 3, 255) for y in (0, 1, 7, 8)], np.uint64)
    a, b = simhash.near_in_list(own, 3), simhash._near_by_masks(own, 3, list(range(8)))
    assert len(set(a)) == len(set(b)) and len(set(zip(a, b, strict=True))) == len(set(a))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(1000, 1000 + k) for k in range(1, 60)] + [(5, 5), (2000, 1999), (1999, 2000)]
    got = {r.node: r.component for r in components(frame(spark, edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {1000 + k: 1000 for k in range(60)} | {1999: 1999, 2000: 1999}
    assert components(frame(spark, [], "u long, v long")).collect() == []


def test_one_of_each_group_stays(spark):
    rows = [(k, f"the same text for all of them {'!' * (k % 2)}") for k in range(5)] + [(9, "another one entirely, of other words"), (None, None)]
    kept = simhash.keep_one(frame(spark, rows).withColumn("fp", F.lit(1)), width=1)
    fps = [plain_fingerprint(t, 1) for _, t in rows]
    root = groups(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    ids = {min(rows[k][0] for k in range(6) if root[k] == g) for g in root[:6]}
    assert {r.doc_id for r in kept.collect()} == ids | {None} and kept.columns == ["doc_id", "text", "fp"]


def test_another_text_of_a_lost_id_stays(spark):
    rng = random.Random(4)
    a, b = sentence(rng, "en", 60), sentence(rng, "de", 60)
    docs = frame(spark, [(1, a), (2, a), (2, b), (None, a)])
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == sorted([(1, a), (2, b)])


def test_without_a_model_texts_with_letters_stay(spark):
    docs = frame(spark, [(1, "a b"), (2, "12 ?"), (3, None)])
    assert [r.doc_id for r in langid.keep_known(docs, None).collect()] == [1]


def test_removing_spans_and_documents(spark):
    bench = frame(spark, [(1, "a b c d e")], "item_id long, text string")
    docs = frame(spark, [(1, "X, a b C D e; y"), (2, "none"), (3, None), (4, "a b c d e a b c d e")]).withColumn("row", F.lit(7))
    cut = {r.doc_id: (r.text, r.row) for r in decontaminate.remove_spans(docs, bench, n=5).collect()}
    assert cut == {1: ("X, ; y", 7), 2: ("none", 7), 3: (None, 7), 4: ("", 7)}
    assert {r.doc_id for r in decontaminate.remove_documents(docs, bench, n=5).collect()} == {2, 3}


def test_a_large_benchmark_is_taken_in_blocks(spark):
    rng = random.Random(2)
    items = [(k, sentence(rng, "en", 20)) for k in range(30)]
    docs = frame(spark, [(k, f"{sentence(rng, 'de', 10)} {items[k % 30][1]}") for k in range(40)] + [(99, None)])
    bench = frame(spark, items, "item_id long, text string")
    whole, blocks = (sorted(map(str, decontaminate.find_hits(docs, bench, block_bytes=b).collect())) for b in (1 << 24, 800))
    assert whole == blocks


def test_model_probabilities_sum_to_one(spark):
    docs = frame(spark, [r[:2] for r in documents()])
    voc = lm.vocabulary(lm.word_counts(docs).cache())
    tables = lm.score_tables(lm.fit(docs, voc, warm_docs=20))
    for c1, c2 in ((0, 0), (1, 5), (900, 3)):
        p = 10 ** (tables["near"][c1] + tables["far"][c2] - tables["z"][c1, c2]).astype(float)
        assert abs(p.sum() - 1) < 1e-4
    inside = np.zeros(lm.SHARED)
    own = np.zeros(lm.SHARED)
    for w, k in voc["index"].items():
        if k >= lm.OWN:
            inside[lm.shared_class(w)] += voc["count"][k] + 0.5
    assert np.allclose(voc["mass"], inside + own + 0.5)


def test_model_beats_the_base_on_unseen_texts(spark):
    rng = random.Random(8)
    text = lambda: " ".join(w for _ in range(60) for w in rng.choice((("red", "green", "blue"), ("one", "two", "three"))))
    learn, other = frame(spark, [(k, text()) for k in range(400)]), frame(spark, [(k, text()) for k in range(20)])
    got = lm.score(other, learn).collect()
    assert all(r.score > 0.75 * r.base_score for r in got)


@pytest.fixture(scope="module")
def tables():
    return bpe.load(tokenizer_path("word_bpe_49k.json"))


def test_pair_table_against_merging(tables):
    rng = random.Random(1)
    usable, names = list(tables["usable"]), tables["names"]
    by_name = {n: i for i, n in enumerate(names)}

    def symbols(i):
        t = tables["usable"][i]
        chars = list(t[:-1] if t.endswith("\n") else t)
        return [by_name[c + ("</w>" if t.endswith("\n") and k == len(chars) - 1 else "")] for k, c in enumerate(chars)]

    open_ended = [i for i in usable if not tables["usable"][i].endswith("\n")]
    pairs = [(rng.choice(open_ended), rng.choice(usable)) for _ in range(2000)] + [p for p in list(tables["ranks"])[:3000]]
    for i in rng.sample(open_ended, 1500):
        t = names[i]
        pairs += [(by_name[t[:k]], by_name[t[k:]]) for k in range(1, len(t)) if t[:k] in by_name and t[k:] in by_name]
    for a, b in pairs:
        if a in tables["right"] and b in tables["left"]:
            assert bpe.compatible(tables["right"][a], tables["left"][b], tables["ranks"]) == (bpe.merged(symbols(a) + symbols(b), tables["ranks"]) == [a, b])


def test_encoding_then_decoding(spark, tables):
    docs = frame(spark, [(1, "Hello  brave new world"), (2, None), (None, "")])
    path = tokenizer_path("word_bpe_49k.json")
    got = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    assert got == {1: "hello</w> brave</w> new</w> world</w>", 2: "", None: ""}


def test_slices_of_long_texts_count_alike(monkeypatch):
    letters = langid.letter_table()
    text = sentence(random.Random(3), "fr", 300)
    whole = langid.ngram_counts(text, letters)
    monkeypatch.setattr(langid, "_SLICE", 37)
    assert (langid.ngram_counts(text, letters) == whole).all()


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 3, 2000)
    scores = 8 * (np.eye(3)[np.where(rng.random(2000) < 0.8, truth, rng.integers(0, 3, 2000))])
    t = langid.temperature(scores, truth)
    p = langid._softmax(scores / t).max(axis=1).mean()
    assert abs(p - (scores.argmax(axis=1) == truth).mean()) < 0.02


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(6)
    one = fingerprint.sampler(1024)
    for _ in range(8):
        a, b = sentence(rng, "en", 120), sentence(rng, "en", 30)
        b = a[:len(a) * rng.randint(1, 3) // 4] + " " + b
        terms = []
        for t in (a, b):
            terms.append(Counter(t.lower().split()))
        true = sum((terms[0] & terms[1]).values()) / sum((terms[0] | terms[1]).values())
        assert abs(fingerprint.likeness(*one(a, b)) - true) < 0.09
        assert all((x == y).all() for x, y in zip(one(a, b), one(a) + one(b), strict=True))
    assert one("") == (None,) and fingerprint.likeness(None, None) == 1 and fingerprint.likeness(None, *one("a")) == 0


def test_word_order_tells_texts_apart(spark):
    rng = random.Random(7)
    words = [f"w{rng.randint(0, 200)}" for _ in range(300)]
    other = rng.sample(words, len(words))
    terms = [Counter(w) + Counter(zip(w, w[1:], strict=False)) for w in (words, other)]
    true = sum((terms[0] & terms[1]).values()) / sum((terms[0] | terms[1]).values())
    texts = [" ".join(words), " ".join(other)]
    assert true < 0.5 and abs(fingerprint.likeness(*fingerprint.sampler(1024, pairs=True)(*texts)) - true) < 0.06
    both = {r.doc_id: r for r in fingerprint.with_next(frame(spark, list(enumerate(texts))), samples=1024).collect()}
    assert abs(both[1].near_next - true) < 0.06


def test_slices_of_long_texts_sample_alike(monkeypatch):
    text = sentence(random.Random(3), "de", 900)
    whole = fingerprint.sampler(32)(text)[0]
    monkeypatch.setattr(fingerprint, "_SLICE", 10)
    assert (fingerprint.sampler(32)(text)[0] == whole).all()


def test_trees_and_isotonic_calibration():
    rng = np.random.default_rng(1)
    x = rng.random((4000, toxicity.FEATURES))
    y = ((x[:, 2] > 0.7) & (x[:, 5] > 0.3)).astype(float)
    y = np.where(rng.random(4000) < 0.05, 1 - y, y)
    model = toxicity._Trees.fit(x[:2000], y[:2000], np.ones(2000))
    at, p = toxicity.isotonic(toxicity._Trees.score(model, x[2000:3000]), y[2000:3000], np.ones(1000))
    said = np.interp(toxicity._Trees.score(model, x[3000:]), at, p)
    assert (np.diff(at) > 0).all() and (np.diff(p) > 0).all()
    assert ((said > 0.5) == (y[3000:] > 0.5)).mean() > 0.92


def test_toxic_texts_are_told_apart(spark, tmp_path):
    rng = random.Random(9)
    docs, labels = [], []
    for k in range(900):
        toxic = k % 4 == 0
        text = sentence(rng, rng.choice(["en", "de"]), 40)
        if toxic:
            w = text.split()
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "stupidly", "loser", "YOU moron"]))
            text = " ".join(w)
        docs.append((k, text))
        labels.append((k, int(toxic)))
    frames = frame(spark, docs), frame(spark, labels, "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.predict(frames[0], toxicity.train(*frames)).collect()}
    from zlib import crc32
    held = [k for k in range(900) if crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(scores[k] >= 0.5) == bool(labels[k][1]) for k in held]) > 0.95


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(1500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(2))
        most, true = rng.randint(0, 14), levenshtein(a, b)
        got = lines.edit_distance(a, b, most)
        assert got == true or got == most + 1 and true > most


@pytest.mark.parametrize("list_rows", [lines.LIST_ROWS, 2])
def test_line_dedup(spark, list_rows):
    rows = [r for r in documents() if r[0] != 1]
    kind = {}
    for i, text, *_ in sorted((r for r in rows if r[1]), key=lambda r: -1 if r[0] is None else r[0]):
        for k, line in enumerate(text.split("\n")):
            if n := lines.normalised(line):
                kind.setdefault(n, (i, k))
    names = list(kind)
    root = groups(len(names), lambda i, j: lines.similar(names[i], names[j]))
    order = lambda o: (-1 if o[0] is None else o[0], o[1])
    keep = {n: min((kind[names[j]] for j in range(len(names)) if root[j] == root[k]), key=order) for k, n in enumerate(names)}
    wanted = []
    for i, text, *_ in rows:
        out = [x for k, x in enumerate((text or "").split("\n")) if not (n := lines.normalised(x)) or keep[n] == (i, k)]
        wanted.append((i, None if text is None else "\n".join(out)))
    docs = frame(spark, [r[:2] for r in rows]).withColumn("key", F.lit("own")).withColumn("line", F.lit(3))
    got = lines.dedup(docs, list_rows=list_rows)
    assert got.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, wanted))
    assert len(set(root)) < len(root)


def test_lines_with_replaced_words_meet(spark):
    """Recall against brute force on edit similarity alone."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    pairs = []
    for k in range(160):
        a = [word() for _ in range((6, 12, 30, 150)[k % 4])]
        b = list(a)
        for at in rng.sample(range(len(a)), max(1, len(a) // (10, 6, 8)[k % 3])):
            b[at] = word()
        pairs.append((" ".join(a), " ".join(b)))
    texts = [t for pair in pairs for t in pair]
    docs = frame(spark, list(enumerate(texts)))
    gone = {r.doc_id for r in lines.dedup(docs).collect() if not r.text}
    wanted = {2 * k + 1 for k, (a, b) in enumerate(pairs) if lines.similar(a, b)}
    assert gone <= wanted and len(wanted) > 100
    assert len(gone) >= 0.97 * len(wanted)


def test_long_lines_with_small_edits_are_candidates():
    rng = random.Random(22)
    word = lambda: rng.choice(("the", "of", "and", "to", "in")) if rng.random() < 0.4 else "".join(rng.choice("abcdefghijklm") for _ in range(6))
    for _ in range(60):
        a = [word() for _ in range(150)]
        b = list(a)
        for at in rng.sample(range(150), 8):
            b[at] = word()
        *prints, keys = lines.line_prints([" ".join(a).encode(), " ".join(b).encode()])
        assert sum(int(a ^ b).bit_count() for a, b in (p.view(np.uint64) for p in prints)) <= lines.DISTANCE
        assert set(keys[0]) & set(keys[1])


@pytest.mark.parametrize("list_rows", [lines.LIST_ROWS, 7])
def test_lines_of_the_same_words_in_one_long_list(spark, list_rows):
    texts = [" ".join(["0 0 0"] * n) + end for n in range(2, 40) for end in ("", " total", " sum of all")]
    root = groups(len(texts), lambda i, j: lines.similar(texts[i], texts[j]))
    got = lines.dedup(frame(spark, list(enumerate(texts))), list_rows=list_rows)
    assert {r.doc_id for r in got.collect() if r.text} == set(root) and len(set(root)) > 1


def test_karmarkar_karp_balances():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 5000, 3000)
    place = sharding.single_places(sizes, 40)
    loads = np.bincount(place, sizes, 40)
    assert loads.max() - loads.min() <= 10
    # two numbers of the textbook example: 8 7 6 5 4 leaves a difference of 2
    loads = np.bincount(sharding.single_places(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4], 2)
    assert abs(loads[0] - loads[1]) == 2


def test_blocks_of_groups_still_balance(spark):
    rng = random.Random(7)
    docs = frame(spark, [(k, "x" * rng.randint(0, 900) + str(k)) for k in range(2000)] + [(5000 + k, "hot text") for k in range(900)])
    got = sharding.balance(docs, 8, block_groups=100, block_rows=200).collect()
    loads, slots, hot = Counter(), {}, set()
    for r in got:
        loads[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        if r.doc_id >= 5000:
            hot.add(r.shard)
    assert len(got) == 2900 and len(hot) == 1 and max(loads.values()) - min(loads.values()) < 100
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_token_files_are_flat(spark, tmp_path):
    docs = frame(spark, [(k, f"text number {k}") for k in range(50)]).repartition(5)
    manifest = tokenfile.write(docs, tokenizer_path("byte_bpe_50k.json"), f"{tmp_path}/files")
    parts = sorted(manifest.collect(), key=lambda r: r.part)
    flat = np.concatenate([np.fromfile(p.file + ".bin", p.dtype) for p in parts])
    offsets = np.concatenate([p.base + np.fromfile(p.file + ".off", "<u8")[:-1] for p in parts])
    rows = sorted(tokenfile.read(spark, manifest).collect())
    assert [r.doc_id for r in rows] == list(range(50)) and [r.start for r in rows] == offsets.tolist()
    assert (np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]) == flat).all()


def test_pipeline_stages(spark, tmp_path):
    """Every stage against its brute-force version on its own input."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    rows = [r for r in documents() if r[0] not in (None, 0, 1)]
    folder = write(tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r.asDict() for r in docs.collect()}
    letters = {r[0] for r in rows if r[1] and any(map(str.isalpha, r[1]))}
    assert set(seen["language_id"]) == letters
    deduped = seen["line_dedup"]
    assert set(deduped) == letters and all(d["n_chars"] == len(d["text"]) for d in deduped.values())
    fps = [(i, plain_fingerprint(d["text"])) for i, d in sorted(deduped.items())]
    root = groups(len(fps), lambda i, j: (fps[i][1] ^ fps[j][1]).bit_count() <= 3)
    assert set(seen["near_dedup"]) == {fps[k][0] for k in set(root)}
    known = decontaminate.window_set([("1", "the of and that with house river mountain little people water the of and that"), ("2", "two words")], 13)
    clean = set()
    for i, d in seen["near_dedup"].items():
        words = decontaminate.folded(d["text"]).split()
        hit = {k for a, b, _ in decontaminate.window_hits(known, words) for k in range(a, b)}
        if not hit or 20 * len(hit) < len(words):
            clean.add(i)
    assert set(seen["decontamination"]) == clean and clean < set(seen["near_dedup"])
    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    assert {i: r["n_tokens"] for i, r in seen["bpe_encoding"].items()} == {
        i: len(lib.encode(d["text"], add_special_tokens=False).ids) for i, d in seen["decontamination"].items()}
