"""Token files: flat unsigned ids, 64-bit offsets, read by memory map.

Documents are range-partitioned by id and sorted, so file order is id order.
Each task encodes its documents and writes three flat files into the shared
folder: ``.bin`` (ids, 16 bits if the vocabulary allows, else 32), ``.off``
(64-bit offsets in ids, one more than documents) and ``.doc`` (64-bit document
ids). A task's files carry a name of its own attempt, and only files of tasks
that succeeded get into the manifest, so a lost executor leaves stray files at
worst, never a mixed-up one. The manifest has one row for each file; prefix
sums over it give every file its base, so a document's global place is base
plus offset.

Ids come from the tokenizers library. Texts are first cut where its
pre-tokenizer always cuts (before a space or line break between words), and the
ids of such chunks are cached, as the library itself would encode them. The
texts of a batch (a few million characters, or one text) share their look-ups:
each distinct chunk is looked up once, and the ids are gathered by number. A text
with other white space, or with an added token, is encoded by itself.

Defined cases: a null text is an empty one, of which only the end id is written.
Rows without an id come first and read back as null. Rows that share an id are
ordered by text. An empty table gives no file and no row. Other columns are
ignored.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartwise.llm.common import WHITE, Recent, batch_rows, byte_chars, id_and_text, materialise, to_batches
from chartwise.session import scratch_path

NO_ID = np.iinfo(np.int64).min
_CACHED_CHARS = 64
#: Characters of texts that are encoded together, parts of texts whose ids are gathered together.
_TOGETHER, _PARTS = 1 << 22, 1 << 18


class Short(Recent):
    """A cache that keeps only what short texts give."""

    def __missing__(self, key: str):
        if len(key) > _CACHED_CHARS:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def encoders(spec: str, dtype: str):
    """The functions text -> ids as bytes and list of texts -> list of these,
    for a byte-level BPE tokenizer file with the usual pattern and no
    normaliser; other files are left to the library."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(spec)
    parsed = json.loads(spec)
    width = int(dtype[-1])
    code = {2: "H", 4: "I"}[width]

    def slow(text: str) -> bytes:
        return np.array(whole.encode(text, add_special_tokens=False).ids, dtype).tobytes()

    front = parsed["pre_tokenizer"] or {}
    if parsed["normalizer"] or front.get("type") != "ByteLevel" or front.get("add_prefix_space") or not front.get("use_regex", True):
        return slow, lambda texts: [slow(t) for t in texts]
    model = whole.model
    to_char = byte_chars()
    space = to_char[0x20]
    letters = "A-Za-zÀ-ÖØ-öø-ÿ"
    plain = re.compile(f" ?[!-~{letters}]+")
    # the pre-tokenizer's pattern, as it works on such chunks
    pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[0-9]+| ?[^ {letters}0-9]+")
    word = re.compile(f" ?[{letters}]+")

    def piece(text: str) -> bytes:
        chars = text.replace(" ", space) if text.isascii() else text.encode().decode("latin-1").translate(to_char)
        ids = array(code, [t.id for t in model.tokenize(chars)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    known = Recent(piece)

    def chunk(text: str) -> bytes:
        if len(text) <= _CACHED_CHARS and plain.fullmatch(text):
            parts = pieces.findall(text)
            # a chunk of one piece is cached as a chunk already
            return piece(text) if len(parts) == 1 else b"".join([known[p] for p in parts])
        return slow(text)

    # white space other than the two kinds that part words of most texts
    other_white = re.compile("[" + "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c) and c not in " \n") + "\x1c-\x1f]")

    def element(text: str) -> bytes | None:
        """The ids of a part of a text as ``many`` cuts it; None if its white
        space is not what that expects."""
        if len(text) <= _CACHED_CHARS and word.fullmatch(text):
            return piece(text)
        return None if text == " " or other_white.search(text) else chunk(text)

    cache, elements = Short(chunk, 100_000), Short(element, 600_000)
    safe = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?=[{WHITE}][^{WHITE}])|[{WHITE}]+")
    added = [t["content"] for t in parsed["added_tokens"]]

    def one(text: str) -> bytes:
        if any(a in text for a in added):  # the library cuts these out first
            return slow(text)
        return b"".join([cache[c] for c in safe.findall(text)])

    def even(text: str) -> bool:
        """No sign of white space other than single spaces, or up to two line
        feeds, between words; ``element`` sees the rest."""
        return bool(text) and text[0] not in " \n" and text[-1] not in " \n" and "\n " not in text and "\n\n\n" not in text \
            and not any(a in text for a in added)

    ascii_letter = np.array([chr(c).isalpha() and c < 0x80 for c in range(256)])
    ascii_other = np.array([0x20 < c < 0x7F and not chr(c).isalpha() for c in range(256)])

    def many(texts: list[str]) -> list[bytes]:
        """All texts are cut at once where the pre-tokenizer always cuts: at a
        space, around a line feed, and where a visible ASCII character other
        than a letter follows a letter. Each distinct part is looked up, and
        the ids are gathered by its number."""
        at = [k for k, text in enumerate(texts) if even(text)]
        some = [texts[k].encode() for k in at]
        data = np.frombuffer(b"".join(some), np.uint8)
        begin = np.cumsum([0, *map(len, some)])
        letter, feed = ascii_letter[data], data == 0x0A
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        starts = (data == 0x20) | feed
        starts[1:] |= feed[:-1] | letter[:-1] & ascii_other[data[1:]]
        starts[begin[:-1]] = True
        starts = np.flatnonzero(starts)
        parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)).dictionary_encode()
        number = parts.indices.to_numpy()
        found = list(map(elements.__getitem__, parts.dictionary.to_numpy(zero_copy_only=False).tolist()))
        strange = np.array([e is None for e in found], bool)
        found = [e or b"" for e in found]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // width
        first, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), dtype)
        ids = []
        for k in range(0, len(number), _PARTS):
            n = sizes[number[k:k + _PARTS]]
            to = np.repeat(first[number[k:k + _PARTS]] - np.cumsum(n) + n, n)
            ids.append(flat[to + np.arange(len(to))].tobytes())
        ids = b"".join(ids)
        ends = np.searchsorted(starts, begin)
        bounds = (np.concatenate([[0], np.cumsum(sizes[number])])[ends] * width).tolist()
        odd = np.diff(np.concatenate([[0], np.cumsum(strange[number])])[ends]) > 0
        out: list[bytes | None] = [None] * len(texts)
        for k, a, b in zip(at, bounds, bounds[1:], strict=False):
            out[k] = ids[a:b]
        for k in np.flatnonzero(odd).tolist():
            out[at[k]] = None
        return [one(text) if raw is None else raw for text, raw in zip(texts, out, strict=True)]

    return lambda text: many([text])[0], many


def chunk_encoder(spec: str, dtype: str):
    """The function text -> ids as bytes."""
    return encoders(spec, dtype)[0]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    fs, at = pafs.FileSystem.from_uri(path if "://" in path or path.startswith(("/", "file:")) else f"file://{path}")
    return fs, at


def _together(rows: Iterable[tuple]) -> Iterator[tuple[list, list[str]]]:
    """The rows in lists of ids and texts (null: empty), of ``_TOGETHER``
    characters or one longer text."""
    ids, texts, held = [], [], 0
    for i, text in rows:
        text = text or ""
        if texts and (held + len(text) > _TOGETHER or len(texts) >= _TOGETHER >> 8):
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(i)
        texts.append(text)
        held += len(text)
    if texts:
        yield ids, texts


def write(docs: DataFrame, path: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write token files below ``folder`` (shared by all executors) and return
    the manifest: part, file, n_docs, n_ids, base, dtype."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    parsed = json.loads(spec)
    most = max([*parsed["model"]["vocab"].values(), *[t["id"] for t in parsed["added_tokens"]], end_id])
    dtype = "<u2" if most < 1 << 16 else "<u4"
    shared = docs.sparkSession.sparkContext.broadcast({"spec": spec})
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        if "encode" not in state:
            state["encode"] = encoders(state["spec"], dtype)[1]
        end = np.array([end_id], dtype).tobytes()
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:08d}-{uuid.uuid4().hex}"
        fs, at = _open(name)
        out, offsets, ids = None, [0], []
        for some, texts in _together(batch_rows(batches)):
            if out is None:
                fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                out = fs.open_output_stream(f"{at}.bin")
            for i, raw in zip(some, state["encode"](texts), strict=True):
                out.write(raw + end)
                offsets.append(offsets[-1] + len(raw) // int(dtype[-1]) + 1)
                ids.append(NO_ID if i is None else i)
        if out is None:
            return iter(())
        out.close()
        for ext, values, kind in ((".off", offsets, "<u8"), (".doc", ids, "<i8")):
            with fs.open_output_stream(at + ext) as f:
                f.write(np.array(values, kind).tobytes())
        return to_batches([(part, name, len(ids), offsets[-1])], schema)

    # rows of one id are parted by how their texts begin
    placed = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    files = materialise(placed.mapInArrow(run, "part int, file string, n_docs long, n_ids long"), "token-manifest")
    # a row for each file: small at any input size
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return materialise(files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))
                       .withColumn("dtype", F.lit(dtype)), "token-manifest")


def _mapped(fs: pafs.FileSystem, at: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped where it is a local or mounted
    one, else read."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(at, dtype, "r") if fs.get_file_info(at).size else np.empty(0, dtype)
    with fs.open_input_file(at) as f:
        return np.frombuffer(f.readall(), dtype)


def read(spark: SparkSession, manifest: DataFrame, ids: bool = True) -> DataFrame:
    """Every document from the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), and with ``ids`` these ids as a binary."""
    n = max(1, manifest.count())
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), *[("ids", pa.binary())] * ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for name, base, dtype in batch_rows(batches):
                fs, at = _open(name)
                flat, offsets, docs = (_mapped(fs, at + ext, kind) for ext, kind in ((".bin", dtype), (".off", "<u8"), (".doc", "<i8")))
                for k, doc in enumerate(docs.tolist()):
                    first, past = int(offsets[k]), int(offsets[k + 1])
                    raw = flat[first:past].astype("<u4").tobytes()
                    yield (None if doc == NO_ID else doc, base + first, past - first, zlib.crc32(raw), *[raw] * ids)
        return to_batches(rows(), pa.schema(fields), (lambda r: len(r[4])) if ids else None)

    return manifest.repartitionByRange(n, "part").select("file", "base", "dtype") \
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)


def new_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")
