"""Words of a batch of texts as numpy arrays of 64-bit hashes, without a Python object per word.

All word classes of this package are classes of bytes (ASCII characters, and every byte of a
non-ASCII character alike), so words are runs of a byte class in the UTF-8 text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts of a batch are worked through in groups of about so many bytes, which bounds memory.
GROUP_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
#: Digits, a-z and all bytes of non-ASCII characters, for texts folded before.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower-cases A-Z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base ** 0, 1, ... n - 1 modulo 2 ** 64."""
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base, np.uint64)]))


def _power_table(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = powers(max(n, 2 * len(_POWERS), 1024))
    return _POWERS


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries of h, at the first one's place; len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * _BASE + h[i:i + n]
    return mixed(out)


def spans(data: np.ndarray, starts: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a text's start (starts) also ends a word before it."""
    inside = word[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cut = starts[starts < len(data)]
    begin[cut] = inside[cut]
    first = np.flatnonzero(begin)
    stop = np.ones(len(data), bool)
    stop[:-1] = ~inside[1:]
    stop[cut[cut > 0] - 1] = True
    return first, np.flatnonzero(stop & inside) + 1


def hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[first:end] for each word."""
    if not len(first):
        return np.zeros(0, np.uint64)
    size = end - first
    total = int(size.sum())
    ahead = np.cumsum(size) - size
    within = np.arange(total) - np.repeat(ahead, size)
    at = within + np.repeat(first, size)
    with np.errstate(over="ignore"):
        return mixed(np.add.reduceat(_BYTE[data[at]] * _power_table(int(size.max()))[within], ahead) + size.astype(np.uint64))


class Group:
    """Some consecutive texts of a batch: their bytes, where each starts, and their words.

    rows: their places in the batch. word_at: for each text and one more, the first word of it.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rows: range, word: np.ndarray):
        self.data, self.offsets, self.rows = data, offsets, rows
        self.first, self.end = spans(data, offsets[:-1], word)
        self.hash = hashes(data, self.first, self.end)
        self.word_at = np.searchsorted(self.first, offsets)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_at)


def groups(texts: pa.Array, word: np.ndarray = NOT_SPACE, fold: np.ndarray | None = None,
           limit: int = GROUP_BYTES) -> Iterator[Group]:
    """The texts of an Arrow string array in groups of about ``limit`` bytes; null counts as empty."""
    texts = texts.cast(pa.large_binary())
    texts = texts.fill_null(b"") if texts.null_count else texts
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        upto = int(np.searchsorted(offsets, offsets[at] + limit, "right"))
        upto = min(max(upto - 1, at + 1), n)
        part = data[offsets[at]:offsets[upto]]
        yield Group(fold[part] if fold is not None else part, offsets[at:upto + 1] - offsets[at], range(at, upto), word)
        at = upto
