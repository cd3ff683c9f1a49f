"""The words of a whole Arrow column of texts at once: places and hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_M = np.uint64(0x9E3779B97F4A7C15)
#: The base of the polynomial (odd) and its inverse modulo 2**64.
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Alphabet:
    """What is a word: ``gaps`` are the bytes between words, ``breaks`` those of
    them that end a piece; ``lower`` folds A-Z for the hashes."""

    def __init__(self, gaps: bytes, breaks: bytes = b"", lower: bool = False):
        every = np.arange(256, dtype=np.uint8)
        self.word = ~np.isin(every, np.frombuffer(gaps + breaks, np.uint8))
        self.breaks = np.isin(every, np.frombuffer(breaks, np.uint8))
        folded = np.where(lower & (every >= 0x41) & (every <= 0x5A), every + 32, every)
        self.value = np.where(self.word, mixed(folded.astype(np.uint64) + np.uint64(1)) | np.uint64(1), np.uint64(0))


@dataclass
class Words:
    raw: np.ndarray  # bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray  # the text of each word
    piece: np.ndarray  # the piece of each word, numbered through all texts
    hashes: np.ndarray
    counts: np.ndarray  # words of each text


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: polynomials over their bytes, with their lengths
    mixed in; a chunk of whole words at a time."""
    out = np.empty(len(starts), np.uint64)
    up = down = np.zeros(0, np.uint64)
    i = 0
    while i < len(starts):
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, a + CHUNK_BYTES, "right")))
        size = int(ends[j - 1] - a)
        if size > len(up):
            up, down = (_powers(b, max(size, CHUNK_BYTES)) for b in (_BASE, _INVERSE))
        at = starts[i:j] - a
        out[i:j] = np.add.reduceat(value[raw[a:a + size]] * up[:size], at) * down[at]
        i = j
    return mixed(out + (ends - starts).astype(np.uint64) * _M)


def words_of(texts: pa.Array, alphabet: Alphabet) -> Words:
    """The words of a column of strings (null: none), in order."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first = int(offsets[0]) if len(texts) else 0
    offsets = offsets - first if len(texts) else np.zeros(1, np.int64)
    size = int(offsets[-1])
    raw = np.frombuffer(texts.buffers()[2], np.uint8, size, first) if size else np.zeros(0, np.uint8)
    word = alphabet.word[raw]
    new = np.zeros(size + 1, bool)
    new[offsets] = True
    gap = np.concatenate([[True], ~word, [True]])
    starts = np.flatnonzero(word & (gap[:size] | new[:size]))
    ends = np.flatnonzero(word & (gap[2:] | new[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    row = np.repeat(np.arange(len(texts)), counts)
    broken = np.flatnonzero(alphabet.breaks[raw]) if alphabet.breaks.any() else np.zeros(0, np.int64)
    piece = row + np.searchsorted(broken, starts)
    return Words(raw, starts, ends, row, piece, _word_hashes(raw, starts, ends, alphabet.value), counts)
