"""Words of whole Arrow text columns as numpy arrays of 64-bit hashes.

A word is a longest run of bytes other than space and 0x09-0x0D. Everything is vectorised
over the bytes of a chunk of documents, so that a word costs some tens of nanoseconds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
#: Documents are worked on in chunks of about this many bytes; a longer document is its own chunk.
CHUNK_BYTES = 1 << 19

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_LOWERED = _BYTE.copy()
_LOWERED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACES = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LENGTHS = _rng.integers(0, 2**64, 64, dtype=np.uint64)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_powers[0]) < n:
        n = max(n, CHUNK_BYTES + 4096)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


class Words:
    """The words of some documents: ``hashes`` of all, ``offsets`` by document, byte spans."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, lower: bool) -> None:
        """``data``: the bytes of all documents, one after the other; ``ends``: where each begins, and the end."""
        space = _SPACE[data]
        inner = ~space
        before = np.empty_like(space)
        before[1:] = space[:-1]
        before[:1] = True
        after = np.empty_like(space)
        after[:-1] = space[1:]
        after[-1:] = True
        edges = ends[:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        before[edges] = True
        after[edges - 1] = True
        self.data = data
        self.starts = np.flatnonzero(inner & before)
        self.stops = np.flatnonzero(inner & after) + 1
        power, inverse = _power(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((_LOWERED if lower else _BYTE)[data] * power[: len(data)], out=sums[1:])
        self.hashes = mixed((sums[self.stops] - sums[self.starts]) * inverse[self.starts])
        self.offsets = np.searchsorted(self.starts, ends)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def plain(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, values = texts.buffers()
    ends = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, dtype=np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def chunks(texts: pa.Array, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, their words) for consecutive rows of the column."""
    data, ends = plain(texts)
    first = 0
    while first < len(ends) - 1:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, side="right")) - 1)
        yield first, last, Words(data[ends[first] : ends[last]], ends[first : last + 1] - ends[first], lower)
        first = last
    pa.default_memory_pool().release_unused()  # a worker lives on for later tasks


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of one document, and the document of each.

    A document with fewer words, but any, has its whole sequence as its one run.
    """
    counts = words.counts()
    n = len(words.hashes)
    total = max(0, n - width + 1)
    rolled = np.zeros(total, dtype=np.uint64)
    for j in range(width):
        rolled += words.hashes[j : j + total] * _PLACES[j]
    owner = np.repeat(np.arange(len(words)), counts)
    left = np.repeat(words.offsets[1:], counts) - np.arange(n)
    whole = left[:total] >= width
    out, doc = mixed(rolled[whole]), owner[:total][whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        sums = _LENGTHS[counts[short]].copy()
        for j in range(width - 1):
            has = counts[short] > j
            sums[has] += words.hashes[words.offsets[short[has]] + j] * _PLACES[j]
        out, doc = np.concatenate([out, mixed(sums)]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        out, doc = out[order], doc[order]
    return out, doc


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of each document in ascending order, and the offsets of the documents."""
    out, doc = windows(words, width)
    bounds = np.searchsorted(doc, np.arange(len(words) + 1))
    out = out.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    first = np.ones(len(out), dtype=bool)
    first[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    out, doc = out[first], doc[first]
    return out, np.searchsorted(doc, np.arange(len(words) + 1))
