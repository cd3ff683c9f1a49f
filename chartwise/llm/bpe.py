"""BPE encoding by backtracking over longest matches, and decoding by offsets.

Merge-by-merge encoding is quadratic or needs a heap. This encoder uses that
a sequence of tokens is the BPE encoding of its text exactly if every two
neighbours are the encoding of their own concatenation. It walks over a word
with the longest token at each place (found by one Aho-Corasick pass), keeps a
token only if a table says that it is compatible with the one before, else tries
the token's next shorter prefix, and steps back from places where none fits;
such a place is never entered again, so the work is linear in the word.

Text is cut at white space first: the tokenizers handled here (a word-end
marker, white space dropped) never look across it, so encodings of whole
space-free chunks are cached. A chunk is normalised and cut into words as the
tokenizer file says. Tables are built once on the driver and broadcast: the
vocabulary is their bound.

Defined cases: a null text is encoded as an empty one: no tokens. Special
tokens' strings within a text become the special ids, as in the library. A
very long text or word is encoded whole. Repeated rows are encoded one by one,
null ids are kept, and other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwise.llm.common import WHITE, Recent, batch_rows, byte_chars, id_and_text, to_batches

#: Chunks longer than this are not worth a place in the cache.
_CACHED_CHARS = 64
_PAIRS = 400_000
_END = "\n"  # the word end within a word; no byte-level character


_NEVER = 1 << 30


def merged(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]], steps: list | None = None) -> list[int]:
    """Textbook BPE: again and again the pair of lowest rank, leftmost first.
    Used on single tokens; ``steps`` gets the pairs merged."""
    out = list(symbols)
    while len(out) > 1:
        rank, at = min((ranks[p][0], k) if (p := (out[k], out[k + 1])) in ranks else (_NEVER, k) for k in range(len(out) - 1))
        if rank == _NEVER:
            break
        if steps is not None:
            steps.append((out[at], out[at + 1]))
        out[at:at + 2] = [ranks[out[at], out[at + 1]][1]]
    return out


def spines(parts: dict[int, tuple[int, int]], ranks: dict) -> tuple[dict, dict]:
    """For each token what stands at its right and at its left edge while it
    is being merged: (token, rank of the merge that takes it up), smallest
    first, the token itself last."""
    right: dict[int, list] = {}
    left: dict[int, list] = {}
    for i, side, k in [(i, s, k) for i in parts for s, k in ((right, 1), (left, 0))]:
        todo = []
        while i not in side:
            todo.append(i)
            if parts[i] is None:
                break
            i = parts[i][k]
        for t in reversed(todo):
            side[t] = [*side[parts[t][k]][:-1], (parts[t][k], ranks[parts[t]][0]), (t, _NEVER)] if parts[t] else [(t, _NEVER)]
    return right, left


def compatible(a: list, b: list, ranks: dict) -> bool:
    """Whether two tokens stay as they are side by side, from the right spine
    of the first and the left spine of the second. Merges happen in order of
    rank, and a token's parts have lower ranks than itself, so it is enough to
    follow what meets at the border; of equal ranks the left one is first."""
    i = j = 0
    while True:
        (x, x_until), (y, y_until) = a[i], b[j]
        rank = ranks.get((x, y), (_NEVER,))[0]
        if rank < x_until and rank <= y_until and rank != _NEVER:
            return False
        if x_until == y_until == _NEVER:
            return True
        if x_until <= y_until:
            i += 1
        else:
            j += 1


#: Fixed value: how the usual tokenizer file cuts words; of another file's pattern the library takes care.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def load(path: str) -> dict:
    """Tables of a word-end BPE tokenizer file, as plain containers."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    suffix = model["end_of_word_suffix"]
    if model["type"] != "BPE" or not suffix or spec.get("decoder"):
        raise ValueError("this encoder is for BPE files with a word-end suffix and no decoder")
    vocab = model["vocab"]
    ranks = {}
    for k, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        ranks[vocab[a], vocab[b]] = (k, vocab[a + b])

    def symbols(token: str) -> list[int]:
        ended = token.endswith(suffix) and token != suffix
        chars = list(token[:-len(suffix)] if ended else token)
        if ended:
            chars[-1] += suffix
        return [vocab[c] for c in chars]

    parts, usable = {}, {}
    for token, i in vocab.items():
        try:
            s = symbols(token)
        except KeyError:
            continue
        steps: list = []
        if merged(s, ranks, steps) == [i]:  # others never come out of the merges
            parts[i] = steps[-1] if steps else None
            usable[i] = token[:-len(suffix)] + _END if token.endswith(suffix) and len(token) > len(suffix) else token
    by_text = {t: i for i, t in usable.items()}
    shorter = {i: next((by_text[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by_text), -1) for i, t in usable.items()}
    right, left = spines(parts, ranks)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError("added tokens with options are not handled")
    names = [""] * (max([*vocab.values(), *added.values()]) + 1)
    for t, i in [*vocab.items(), *added.items()]:
        names[i] = t
    front = {k: spec[k] for k in ("version", "normalizer", "pre_tokenizer")}
    front |= {"added_tokens": [], "truncation": None, "padding": None, "post_processor": None, "decoder": None,
              "model": {"type": "BPE", "vocab": {}, "merges": []}}
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    steps = ((spec["normalizer"] or {}).get("normalizers") or [])
    usual = [x.get("type") for x in steps] == ["NFC", "Replace", "Lowercase"] and (split[0].get("pattern") or {}).get("Regex") == WORD_PATTERN
    return {"usual": usual, "ranks": ranks, "right": right, "left": left, "usable": usable, "shorter": shorter, "added": added,
            "front": json.dumps(front), "names": names}


def encoder(tables: dict):
    """The function text -> (ids as little-endian unsigned 32-bit integers)."""
    import ahocorasick
    from tokenizers import Tokenizer

    ranks, right, left, shorter, added = (tables[k] for k in ("ranks", "right", "left", "shorter", "added"))
    length = {i: len(t) for i, t in tables["usable"].items()}
    whole = {t: i for i, t in tables["usable"].items()}
    automaton = ahocorasick.Automaton()
    for i, t in tables["usable"].items():
        automaton.add_word(t, i)
    automaton.make_automaton()
    pairs = Recent(lambda p: compatible(right[p[0]], left[p[1]], ranks), _PAIRS)
    to_char = byte_chars()

    def word(text: str) -> list[int]:
        """Ids of one word, given in byte-level characters."""
        text += _END
        if (one := whole.get(text)) is not None:
            return [one]
        longest = [-1] * len(text)
        for last, i in automaton.iter(text):
            longest[last + 1 - length[i]] = i  # later matches from the same start are longer
        path: list[int] = []
        dead: set[int] = set()
        at, i = 0, longest[0]
        while at < len(text):
            while i >= 0 and (at + length[i] in dead or path and not pairs[path[-1], i]):
                i = shorter[i]
            if i >= 0:
                path.append(i)
                at += length[i]
                i = longest[at] if at < len(text) else -1
            else:  # the text up to here doesn't end at a token's end
                dead.add(at)
                i = path.pop()
                at -= length[i]
                i = shorter[i]
        return path

    front = Tokenizer.from_str(tables["front"])
    if not tables["usual"]:  # white space need not part words there
        def slow(text: str) -> bytes:
            return b"".join(np.array(word(w), "<u4").tobytes() for w, _ in front.pre_tokenizer.pre_tokenize_str(
                front.normalizer.normalize_str(text) if front.normalizer else text))
    # characters that composing leaves alone and lower() maps one to one
    plain = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    # must equal the tokenizer file's pattern on such characters
    simple = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    known = Recent(lambda w: np.array(word(w), "<u4").tobytes())

    def chunk(text: str) -> bytes:
        if tables["usual"] and plain.fullmatch(text):
            words = [w.encode().decode("latin-1").translate(to_char) for w in simple.findall(text.lower())]
        else:
            words = [w for w, _ in front.pre_tokenizer.pre_tokenize_str(front.normalizer.normalize_str(text))]
        return b"".join([known[w] if len(w) <= _CACHED_CHARS else np.array(word(w), "<u4").tobytes() for w in words])

    cache = Recent(chunk)
    specials = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
    white = re.compile(f"[{WHITE}]+")
    separators = re.compile("[\x1c-\x1f]")

    def plain_text(text: str) -> bytes:
        if not tables["usual"]:
            return slow(text)
        chunks = [c for c in white.split(text) if c] if separators.search(text) else text.split()
        return b"".join([cache[c] if len(c) <= _CACHED_CHARS else chunk(c) for c in chunks])

    def encode(text: str) -> bytes:
        if not specials or not specials.search(text):
            return plain_text(text)
        out, at = [], 0
        for m in specials.finditer(text):
            out += [plain_text(text[at:m.start()]), np.uint32(added[m[0]]).astype("<u4").tobytes()]
            at = m.end()
        return b"".join([*out, plain_text(text[at:])])

    return encode


def decoder(names: list[str]):
    """The function ids -> text: tokens lie end to end in one buffer, each
    with the space that parts it from the next, and are gathered by offset."""
    raw = [(n + " ").encode() for n in names]
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    sizes = np.diff(offsets)

    def decode(ids: np.ndarray) -> bytes:
        out = []
        for at in range(0, len(ids), 1 << 16):
            some = ids[at:at + (1 << 16)]
            n = sizes[some]
            starts = np.repeat(offsets[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            out.append(buffer[starts + np.arange(len(starts))].tobytes())
        return b"".join(out)[:-1]

    return decode


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers in a
    binary; with ``decoded`` also the text decoded from these ids."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    fields = [("doc_id", pa.int64()), ("ids", pa.binary()), *[("decoded", pa.string())] * decoded]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value  # lives as long as the Python worker, with what is built from it
        if "encode" not in tables:
            tables["encode"], tables["decode"] = encoder(tables), decoder(tables["names"])

        def rows():
            for i, text in batch_rows(batches):
                ids = tables["encode"](text or "")
                yield (i, ids, tables["decode"](np.frombuffer(ids, "<u4")).decode()) if decoded else (i, ids)
        return to_batches(rows(), pa.schema(fields), lambda r: len(r[1]) * 4)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(path)["names"])
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = decoder(shared.value)
        return to_batches(((i, one(np.frombuffer(ids or b"", "<u4")).decode()) for i, ids in batch_rows(batches)), schema,
                          lambda r: len(r[1]))

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
