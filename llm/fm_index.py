"""A compressed full-text index over words: Burrows-Wheeler transform in a wavelet matrix."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector of one bit and a half each, that counts its ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=bool)
        padded[: len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.blocks) + 1, dtype=np.int32)
        np.cumsum(np.bitwise_count(self.blocks), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & below)


class Wavelet:
    """Counts a symbol before a place of a sequence in as many steps as symbols have bits."""

    def __init__(self, symbols: np.ndarray, kinds: int) -> None:
        self.levels = []
        for level in reversed(range(max(1, int(kinds - 1).bit_length()))):
            bits = (symbols >> level) & 1 == 1
            self.levels.append((level, Bits(bits), int(len(symbols) - bits.sum())))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        self.first = self._down(np.arange(kinds), np.zeros(kinds, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> level) & 1 == 1, zeros + ones, at - ones)
        return at

    def count(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbol, at) - self.first[symbol]


class FmIndex:
    """Backward search, over some stretches of words, for stretches of up to ``width`` words.

    Suffixes are sorted by as many words as the next power of two has: enough for a search that
    never goes beyond ``width``. ``begin`` and ``end`` are the rows that share the first ``width``
    words with a row: with them a match that has grown longer is cut back to its first ``width``.
    """

    def __init__(self, stretches: list[np.ndarray], width: int) -> None:
        self.width = width
        words = np.concatenate([np.append(x, 0) for x in stretches]) if stretches else np.zeros(1, np.uint64)
        ends = np.cumsum([len(x) + 1 for x in stretches]) - 1
        separator = np.zeros(len(words), dtype=bool)
        separator[ends] = True
        names, symbols = np.unique(words, return_inverse=True)
        self.symbols = np.where(separator, 0, symbols + 1)
        self.kinds, n = len(names) + 1, len(words)
        rank, depth, part = self.symbols.astype(np.int64), 1, None
        while depth < width:
            after = np.zeros(n, dtype=np.int64)
            after[: n - depth] = rank[depth:] + 1
            if 2 * depth >= width:
                rest = np.zeros(n, dtype=np.int64)
                rest[: n - (width - depth)] = rank[width - depth :] + 1
                part = rank * (n + self.kinds + 2) + rest  # the first ``width`` words, as two that overlap
            key = rank * (n + self.kinds + 2) + after
            rank = np.unique(key, return_inverse=True)[1]
            depth *= 2
        self.rows = np.argsort(rank, kind="stable")
        part = self.symbols if part is None else part
        new = np.ones(n, dtype=bool)
        new[1:] = part[self.rows[1:]] != part[self.rows[:-1]]
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        self.groups, self.begin = first, first[group]
        self.end = np.append(first[1:], n)[group]
        self.below = np.zeros(self.kinds + 1, dtype=np.int64)
        np.cumsum(np.bincount(self.symbols, minlength=self.kinds), out=self.below[1:])
        self.wavelet = Wavelet(self.symbols[self.rows - 1], self.kinds)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of matches with one more word at their left."""
        both = self.wavelet.count(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.below[symbol] + both[: len(symbol)], self.below[symbol] + both[len(symbol) :]


def least_owners(stretches: list[np.ndarray], owners: np.ndarray, width: int) -> list[np.ndarray]:
    """For each window of ``width`` words of each stretch the least owner of a stretch that has it.

    All stretches are streamed through the index together, from their last word to the first:
    each step makes every match one word longer at its left, and cuts it to ``width`` words. As a
    stretch is in the index itself its matches never end, and once they have ``width`` words
    they are the windows; the rows of a match tell who else has it.
    """
    index = FmIndex(stretches, width)
    size = np.array([len(x) for x in stretches], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]]) if len(size) else size
    owner = np.repeat(owners, size + 1)[index.rows]
    least = np.minimum.reduceat(owner, index.groups)[np.cumsum(np.isin(np.arange(len(owner)), index.groups)) - 1]
    order = np.argsort(-size, kind="stable")
    out = [np.empty(max(0, n - width + 1), dtype=np.int64) for n in size.tolist()]
    offset = np.concatenate([[0], np.cumsum(np.maximum(0, size - width + 1))])
    flat = np.empty(int(offset[-1]), dtype=np.int64)
    low, high = np.zeros(len(size), dtype=np.int64), np.full(len(size), len(index.symbols), dtype=np.int64)
    for step in range(1, int(size.max(initial=0)) + 1):
        lanes = order[: int(np.searchsorted(-size[order], -step, side="right"))]
        at = start[lanes] + size[lanes] - step
        low[lanes], high[lanes] = index.extend(index.symbols[at], low[lanes], high[lanes])
        if step > width:
            low[lanes], high[lanes] = index.begin[low[lanes]], index.end[low[lanes]]
        if step >= width:
            flat[offset[lanes] + size[lanes] - step] = least[low[lanes]]
    for k in range(len(out)):
        out[k] = flat[offset[k] : offset[k + 1]]
    return out
