"""Encoding with forced boundaries against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm import bpe
from llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Encoder(file.read())


def ours(encoder, text):
    import numpy as np

    return np.frombuffer(encoder.encode(text.encode()), dtype=np.int32).tolist()


ODD = [
    "", " ", "\n\t", "Hello, World!", "don't we'll THEY'RE 'sure 'rest", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|>",
    "café café ́x ÅÅ", "İstanbul ΣΙΣΣ", "1234١٢ ½ x2y3", "  a\u0085b　c",
    "\U0001f600\U0001f468‍\U0001f469 你好世界", "\x00\x1c\x1f\x7f", "qxzjvkqx" * 5, "a'b'c''s", "</w> w</w>", "�﻿",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(encoder, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert ours(encoder, text) == expected
    import numpy as np

    assert encoder.decode(np.array(expected)) == library.decode(expected, skip_special_tokens=False)


def test_all_latin_characters(encoder, library):
    """Each one by itself, inside a word, beside a digit and upper-cased."""
    for code in range(0x180):
        text = f"{chr(code)} a{chr(code)}b{chr(code)}{chr(code)} 1{chr(code)}2 '{chr(code)}s {chr(code).upper()}"
        assert ours(encoder, text) == library.encode(text, add_special_tokens=False).ids, hex(code)


PIECES = st.sampled_from(["'", "s", "'s", "re", "ll", "the", "QX", "1", "9", " ", "\n", "é", "é", "你", "!", "<|", "|>", "<|endoftext|>", "-", "_"])


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(st.characters(max_codepoint=0x17F), max_size=60), st.lists(PIECES, max_size=30).map("".join)))
def test_any_text(encoder, library, text):
    text = text.encode("utf-8", "replace").decode()
    assert ours(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_long_words_and_texts(encoder, library, monkeypatch):
    draw = random.Random(1)
    junk = "".join(draw.choice("abcXYZ0189+/=.'<|>é") for _ in range(30_000))
    letters = "".join(draw.choice("aeqxz") for _ in range(20_000))
    texts = [junk, letters, "x" * 50_000, (junk[:900] + " ") * 40]
    monkeypatch.setattr(bpe, "PIECE_BYTES", 5_000)
    monkeypatch.setattr(bpe, "LONG_WORD", 200)
    for text in texts:
        assert ours(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_boundaries_are_forced(encoder):
    """No token spans two fragments of a part, and some parts have several."""
    parts = encoder.fragments_of("qxjwqzthe")
    assert "".join(parts) == "qxjwqzthe</w>" and len(parts) > 1
    for left, right in zip(parts[:-1], parts[1:], strict=True):
        assert not any(left[-1] + right[0] in token for token in encoder.vocab)


def test_cache_is_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 5_000)
    for cache in (encoder.words, encoder.parts, encoder.fragments):
        cache.clear()
        cache.held = 0
    for text in (" ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}{end}" for i in range(300)) * 2 for end in ("", "é")):
        assert ours(encoder, text) == library.encode(text, add_special_tokens=False).ids
    assert all(cache.held <= 5_000 for cache in (encoder.words, encoder.parts, encoder.fragments))


def test_odd_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (None, "hello", "z"), (2, "Same  same", "y"), (2, "Same  same", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decoded(bpe.encoded(docs, PATH), PATH).collect()
    expected = []
    for key, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((key, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted([tuple(r) for r in out], key=repr) == sorted(expected, key=repr)
    assert bpe.encoded(docs.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, sf_dir, library):
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = set()
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.add((row.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(text)))
    found = QUERIES["op11_bpe"](spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
