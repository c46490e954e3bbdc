"""Byte-pair encoding and decoding with forced boundaries.

A merge makes a token out of two neighbours, so two bytes that stand side by side inside no token
of the vocabulary are never merged, whatever is around them: there is a certain cut between them.
What lies between certain cuts is encoded by itself and the results are put one after the other.

White space is in no token of a tokenizer that drops it, so a text is first cut there into words,
and every different word of a task is worked out once. A word goes through the tokenizer's own
normalisation and splitting (text of Latin characters through the same pattern, a piece of text at a time); each part of it is cut at its forced boundaries, and each fragment is merged by rank.
Nothing is shuffled, and no document waits for another.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words

#: A longer text is worked on in pieces of about so many bytes, cut at white space.
PIECE_BYTES = 1 << 20
#: A longer word is also cut where its ASCII characters always part.
LONG_WORD = 1 << 12
#: Bytes of words and results that a task remembers before it begins anew.
CACHE_BYTES = 64 << 20
#: A fragment of more symbols is merged with a queue.
SHORT = 24
_SPACE = re.compile(rb"[ \t-\r]")
#: Outside printable characters up to U+017F, which NFC leaves as they are and which are letters, numbers or neither for good.
_UNUSUAL = re.compile("[^\t-\r -~\xa1-\u017f]")
_LETTERS, _NUMBERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"


def _usual_pattern(spec: dict) -> re.Pattern | None:
    """The tokenizer's pattern for lower-cased text without unusual characters; None if it isn't made in the known way."""
    lowers = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    if spec.get("normalizer") != {"type": "Sequence", "normalizers": lowers}:
        return None
    match (spec["pre_tokenizer"] or {}).get("pretokenizers"):
        case [{"type": "Split", "pattern": {"Regex": pattern}, "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}]:
            return re.compile(pattern.replace(r"\p{L}", _LETTERS).replace(r"\p{N}", _NUMBERS))
    return None


def byte_characters() -> list[str]:
    """The character that stands for each byte: the printable ones for themselves, the others for those from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(others)) for b in range(256)]


class _Results(dict):
    """What ``work`` makes of a key, worked out once; emptied when it holds ``CACHE_BYTES``."""

    def __init__(self, work: Callable) -> None:
        super().__init__()
        self.work, self.held = work, 0

    def __missing__(self, key):
        out = self.work(key)
        size = len(key) + len(out) + 200
        if size > CACHE_BYTES // 8:
            return out
        self.held += size
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = size
        self[key] = out
        return out


class Encoder:
    """The tokenizer in a JSON text of the tokenizers library: byte-level BPE that drops white space."""

    def __init__(self, source: str) -> None:
        from tokenizers import Tokenizer

        spec = json.loads(source)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"not a plain BPE model: {odd or model['type']}")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be plain")
        contents = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, contents)) + ")") if contents else None
        self.tokens = {**{i: t for t, i in self.vocab.items()}, **{i: t for t, i in self.added.items()}}
        whole = Tokenizer.from_str(source)
        self.normalizer, self.splitter, self.decoder = whole.normalizer, whole.pre_tokenizer, whole.decoder
        if self.splitter is None or [p for p, _ in self.splitter.pre_tokenize_str(" \t\n\r\x0b\x0c")]:
            raise ValueError("the tokenizer must drop white space")
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.ranks = {(self.vocab[a], self.vocab[b]): rank for rank, (a, b) in enumerate(merges)}
        self.made = [self.vocab[a + b] for a, b in merges]
        self.inside = set()
        for token in self.vocab:
            body = token.removesuffix(self.suffix) if self.suffix else token
            self.inside.update(zip(body, body[1:], strict=False))
        self.last = {i: self.vocab[t + self.suffix] for t, i in self.vocab.items() if len(t) == 1 and t + self.suffix in self.vocab}
        self.usual = _usual_pattern(spec)
        self.byte_characters = byte_characters()
        self.fragments = _Results(self._merged)
        self.parts = _Results(self._usual_part)
        self.words = _Results(self._word)
        self._parting: np.ndarray | None = None

    def encode(self, text: bytes) -> bytes:
        """The ids of a text, four bytes each."""
        found = [self._piece(piece) for piece in _pieces(text)]
        return found[0] if len(found) == 1 else b"".join(found)

    def _is_usual(self, text: str) -> bool:
        return self.usual is not None and not _UNUSUAL.search(text) and not any(m in text for m in self.added)

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        if self._is_usual(text):
            return b"".join(map(self.parts.__getitem__, self.usual.findall(text.lower())))
        return b"".join(map(self.words.__getitem__, piece.split()))

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids as the library joins them; an id without a token is left out."""
        found = map(self.tokens.get, ids.tolist())
        if self.decoder is None:
            return " ".join([t for t in found if t is not None])
        return self.decoder.decode([t for t in found if t is not None])

    def fragments_of(self, part: str) -> list[str]:
        """A part of a word cut at its forced boundaries; the last one has the end of the word."""
        if all(map(self.inside.__contains__, zip(part, part[1:], strict=False))):
            return [part + self.suffix]
        cuts = [0, *[i for i, pair in enumerate(zip(part, part[1:], strict=False), 1) if pair not in self.inside], len(part)]
        out = [part[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        out[-1] += self.suffix
        return out

    def _usual_part(self, part: str) -> bytes:
        return self._part(part if part.isascii() else "".join([self.byte_characters[b] for b in part.encode()]))

    def _part(self, part: str) -> bytes:
        fragments = self.fragments_of(part)
        return self._merged(fragments[0]) if len(fragments) == 1 else b"".join(map(self.fragments.__getitem__, fragments))

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if self._is_usual(text):
            return b"".join(map(self.parts.__getitem__, self.usual.findall(text.lower())))
        out = []
        for piece in self.special.split(text) if self.special else [text]:
            if piece in self.added:
                out.append(np.int32(self.added[piece]).tobytes())
            elif len(piece) > LONG_WORD:
                out += [self._plain(p) for p in self._shorter(piece)]
            elif piece:
                out.append(self._plain(piece))
        return b"".join(out)

    def _plain(self, piece: str) -> bytes:
        if self.normalizer is not None:
            piece = self.normalizer.normalize_str(piece)
        return b"".join([self._part(part) for part, _ in self.splitter.pre_tokenize_str(piece)])

    def _shorter(self, piece: str) -> Iterator[str]:
        """A long word in pieces of at least ``LONG_WORD`` characters, cut only where two ASCII characters always part."""
        if self._parting is None:
            self._parting = self._parts()
        code = np.frombuffer(piece.encode("utf-32-le"), dtype=np.uint32)
        plain = np.minimum(code, 128)
        cuts = np.flatnonzero(self._parting[plain[:-1], plain[1:]]) + 1
        first = 0
        while first < len(piece):
            after = np.searchsorted(cuts, first + LONG_WORD)
            last = int(cuts[after]) if after < len(cuts) else len(piece)
            yield piece[first:last]
            first = last

    def _parts(self) -> np.ndarray:
        """The pairs of ASCII characters that the tokenizer parts, but for the signs that longer patterns have."""
        out = np.zeros((129, 129), dtype=bool)
        signs = {"'", *(c for t in self.added for c in t if not c.isalnum())}
        usual = [c for c in map(chr, range(33, 127)) if c not in signs]
        for a in usual:
            for b in usual:
                text = self.normalizer.normalize_str(a + b) if self.normalizer is not None else a + b
                out[ord(a), ord(b)] = len(self.splitter.pre_tokenize_str(text)) == 2
        return out

    def _merged(self, fragment: str) -> bytes:
        """A fragment's characters merged, the pair of least rank first, the leftmost of equals."""
        ends = self.suffix and fragment.endswith(self.suffix)
        symbols = list(map(self.vocab.__getitem__, fragment[: -len(self.suffix)] if ends else fragment))
        if ends:
            symbols[-1] = self.last[symbols[-1]]
        return array("i", self._by_scan(symbols) if len(symbols) <= SHORT else self._by_queue(symbols)).tobytes()

    def _by_scan(self, symbols: list[int]) -> list[int]:
        get, new, never = self.ranks.get, self.made, len(self.made)
        found = list(map(get, zip(symbols, symbols[1:], strict=False), repeat(never)))
        while found:
            best = min(found)
            if best == never:
                break
            at = found.index(best)
            symbols[at : at + 2] = [new[best]]
            del found[at]
            if at < len(found):
                found[at] = get((symbols[at], symbols[at + 1]), never)
            if at:
                found[at - 1] = get((symbols[at - 1], symbols[at]), never)
        return symbols

    def _by_queue(self, symbols: list[int]) -> list[int]:
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        end, ranks = len(symbols), self.ranks
        pairs = enumerate(zip(symbols, symbols[1:], strict=False))
        queue = [(ranks[pair], i, *pair) for i, pair in pairs if pair in ranks]
        heapq.heapify(queue)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            new = self.made[rank]
            j = after[i]
            if symbols[i] != left or j >= end or symbols[j] != right:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
                if (found := ranks.get((new, symbols[after[i]]))) is not None:
                    heapq.heappush(queue, (found, i, new, symbols[after[i]]))
            if before[i] >= 0 and (found := ranks.get((symbols[before[i]], new))) is not None:
                heapq.heappush(queue, (found, before[i], symbols[before[i]], new))
        return [s for s in symbols if s >= 0]


def _pieces(text: bytes) -> Iterator[bytes]:
    first = 0
    while len(text) - first > PIECE_BYTES:
        space = _SPACE.search(text, first + PIECE_BYTES)
        if space is None:
            break
        yield text[first : space.start()]
        first = space.end()
    yield text[first:] if first else text


@lru_cache(maxsize=2)
def _encoder(source: str) -> Encoder:
    """One for a Python worker, whatever number of tasks it runs."""
    return Encoder(source)


def _encoded(source: Broadcast, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source.value)
        for batch in batches:
            data, ends = words.plain(batch.column(1))
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + words.CHUNK_BYTES, side="right")) - 1)
                ids = [encoder.encode(data[a:b].tobytes()) for a, b in zip(ends[first:last], ends[first + 1 : last + 1], strict=True)]
                bounds = np.cumsum([0, *[len(x) // 4 for x in ids]]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first).cast(id_type), pa.ListArray.from_arrays(pa.array(bounds), values)],
                    ["id", "ids"],
                )
                first = last

    return run


def _decoded(source: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source.value)
        for batch in batches:
            column = batch.column(1)
            ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            text = [encoder.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), column, pa.array(text, pa.string())], ["id", "ids", "text"])

    return run


def _sent(docs: DataFrame, tokenizer: str) -> Broadcast:
    """The tokenizer's file, some megabytes however large the corpus is, read by the driver."""
    with open(tokenizer, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encoded(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ids (array of int), as the library encodes the whole text without special tokens around it.

    ``tokenizer`` is the path of a tokenizers JSON file on the driver. A null text has no ids, like an empty
    one; a null id is kept; equal rows come each; an empty table gives none; other columns don't
    matter. Strings of added tokens in a text become their ids, as in the library. Bytes that are not UTF-8 are read as U+FFFD. A
    text of any length is worked on in pieces; only a run of letters beyond ASCII without any white
    space is normalised as a whole.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    slim = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = slim.schema["id"].dataType
    return slim.mapInArrow(_encoded(_sent(docs, tokenizer), to_arrow_type(kind)), f"id {kind.simpleString()}, ids array<int>")


def decoded(rows: DataFrame, tokenizer: str, id: str = "id", ids: str = "ids") -> DataFrame:
    """id, ids and text: what the library makes of the ids, special tokens kept. Null ids are like none."""
    slim = rows.select(F.col(id).alias("id"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(_decoded(_sent(rows, tokenizer)), f"id {kind}, ids array<int>, text string")
