import re

import numpy as np
import pyarrow as pa

from llm import words
from llm.fm_index import FmIndex, Wavelet, least_owners
from llm.graph import forest

TEXTS = ["a b  c", "", None, "\tÄpfel\x0bund\x0cBirnen\r\n", "A b c A", " ", "x" * 5000, "a b c d e f", " a b"]


def plain(text):
    return re.findall(words.WORD, text or "")


def test_words_and_their_hashes():
    seen = {}
    for first, last, some in words.chunks(pa.array(TEXTS, pa.string()), size=16):
        for k in range(last - first):
            got = some.hashes[some.offsets[k] : some.offsets[k + 1]].tolist()
            assert len(got) == len(plain(TEXTS[first + k]))
            for word, value in zip(plain(TEXTS[first + k]), got, strict=True):
                assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_lower_case_is_that_of_ascii_only():
    (_, _, some), = words.chunks(pa.array(["ABC Ä ä abc"]), lower=True)
    assert some.hashes[0] == some.hashes[3] and some.hashes[1] != some.hashes[2]


def test_shingles_of_short_and_long_texts():
    (_, _, some), = words.chunks(pa.array(["a b", "a b", "a b c d e f", "", "b a", "f f f f f f f"]))
    runs, at = words.shingle_sets(some, 5)
    sets = [set(runs[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert [len(x) for x in sets] == [1, 1, 2, 0, 1, 1] and sets[0] == sets[1] != sets[4]


def test_sliced_and_wide_columns():
    texts = pa.array(["skip", "a b", None, "c"]).slice(1)
    for column in (texts, texts.cast(pa.large_string()), pa.chunked_array([texts])):
        assert [x for _, _, some in words.chunks(column) for x in some.counts().tolist()] == [2, 0, 1]
    assert not list(words.chunks(pa.array([], pa.string())))


def test_forest():
    a, b = forest(np.array([5, 4, 9, 2]), np.array([4, 3, 8, 2]))
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == {5: 3, 4: 3, 9: 8}


def test_wavelet_counts():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 11, 500)
    tree = Wavelet(x, 11)
    at, symbol = rng.integers(0, 501, 200), rng.integers(0, 11, 200)
    assert tree.count(symbol, at).tolist() == [(x[:i] == s).sum() for i, s in zip(at, symbol, strict=True)]


def test_backward_search_counts_occurrences():
    rng = np.random.default_rng(2)
    parts = [rng.integers(0, 4, n).astype(np.uint32) for n in (30, 1, 200, 17)]
    index = FmIndex(parts, 6)
    for part in parts:
        for a in range(0, len(part) - 3, 7):
            low, high = np.zeros(1, np.int64), np.full(1, len(index.symbols))
            at = sum(len(x) + 1 for x in parts[: next(i for i, x in enumerate(parts) if x is part)]) + a
            for j in reversed(range(4)):
                low, high = index.extend(index.symbols[[at + j]], low, high)
            wanted = sum((x[i : i + 4] == part[a : a + 4]).all() for x in parts for i in range(len(x) - 3))
            assert high[0] - low[0] == wanted


def test_least_owners():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 3, n).astype(np.uint32) for n in (40, 9, 25, 60, 4)]
    owners = np.array([7, 3, 9, 1, 5])
    for width in (1, 2, 5, 8):
        first = {}
        for part, owner in zip(parts, owners.tolist(), strict=True):
            for i in range(len(part) - width + 1):
                key = part[i : i + width].tobytes()
                first[key] = min(first.get(key, 99), owner)
        for part, got in zip(parts, least_owners(parts, owners, width), strict=True):
            assert got.tolist() == [first[part[i : i + width].tobytes()] for i in range(len(part) - width + 1)]
