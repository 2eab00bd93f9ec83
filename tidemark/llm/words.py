"""Words of whole texts as arrays: boundaries and 64-bit hashes, read from Arrow's bytes.

Every separator of the word patterns used here is ASCII, so words can be cut on UTF-8 bytes: a byte of 128 and above
always belongs to a word. A word's hash is a polynomial over its lower-cased bytes, mixed; it depends on nothing but the
word. Texts are taken in pieces of about ``PIECE`` bytes, a longer text alone, so that memory follows the longest text
and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


class Words(NamedTuple):
    """Words of a run of texts. ``first[i]:first[i + 1]`` are those of text i."""

    data: np.ndarray    # lower-cased bytes of all texts, one 0 byte in front and behind each
    start: np.ndarray   # of each word in data
    end: np.ndarray
    hash: np.ndarray    # uint64
    text: np.ndarray    # index of the text of each word
    first: np.ndarray

    def string(self, word: int) -> str:
        return self.data[self.start[word]:self.end[word]].tobytes().decode("utf-8", "replace")


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of uint64 values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = texts.cast(pa.large_string())
    _, offsets, data = wide.buffers()
    offset = np.frombuffer(offsets, dtype=np.int64, count=wide.offset + len(wide) + 1)[wide.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offset, raw


def pieces(offset: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes."""
    low, count = 0, len(offset) - 1
    while low < count:
        high = max(low + 1, int(np.searchsorted(offset, offset[low] + size, side="right")) - 1)
        yield low, high
        low = high


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES: dict[str, np.ndarray] = {}


def _power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES["up"]) < count:
        size = 1 << max(21, int(count).bit_length())
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _TABLES["up"], _TABLES["down"]


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, equal for equal bytes."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def cut(offset: np.ndarray, raw: np.ndarray, low: int, high: int, inside: np.ndarray) -> Words:
    """The words of texts ``low`` to ``high`` by the byte classes ``inside``."""
    base, sizes = offset[low], np.diff(offset[low:high + 1])
    body = LOWER[raw[base:offset[high]]]
    count = high - low
    data = np.zeros(len(body) + count + 1, dtype=np.uint8)
    shift = np.repeat(np.arange(1, count + 1), sizes)
    data[np.arange(len(body)) + shift] = body
    flag = inside[data]
    gaps = np.concatenate(([0], np.cumsum(sizes + 1)))
    flag[gaps] = False
    edge = np.flatnonzero(flag[1:] != flag[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    text = np.searchsorted(gaps, start, side="right") - 1
    first = np.searchsorted(text, np.arange(count + 1))
    return Words(data, start, end, hashes(data, start, end), text, first)


def each_piece(texts: pa.Array, inside: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int, Words]]:
    """The words of an array of texts, piece by piece."""
    offset, raw = text_buffers(texts)
    for low, high in pieces(offset, size):
        yield low, high, cut(offset, raw, low, high, inside)


def grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within one text, and the first word of each."""
    count = len(words.hash)
    if count < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(count - size + 1, dtype=np.uint64)
    for i in range(size):
        value = value * np.uint64(_BASE) + words.hash[i:count - size + 1 + i]
    at = np.flatnonzero(words.text[:count - size + 1] == words.text[size - 1:])
    return mix(value[at]), at


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
