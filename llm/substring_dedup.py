"""Substring deduplication: words in a window of ``width`` words that an earlier document has too.

A shard's text is held in a compressed FM-index (a wavelet matrix of its Burrows-Wheeler
transform); stretches of documents are streamed through it by backward search, whose matching
statistics, as far as ``width`` words, tell for each window the earliest document that has it.

What goes into which shard is chosen by the text itself. The least hash among the runs of
``RUN`` words in a window is its anchor: equal windows have equal anchors. Windows whose anchor
no other document has are alone. Neighbouring windows with one anchor are a stretch, and all
stretches of an anchor go to one shard, so that each is searched in one shard only and the work
grows with the text. Copies of whole documents are one document, and equal stretches of a group
of documents are sent once, so that a passage that a third of all documents have comes to its
shard once for each group.

Around a common passage each document has a context of its own. So a window whose anchor is common goes by the
hash of all its words instead: it is a stretch by itself, equal wherever it is found. Hashes that are common in
turn are taken as shared without gathering who has them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words
from llm.common import SAMPLE, SHARE, common_values, member
from llm.fm_index import least_owners
from llm.graph import dealt, kept, packed, text_bytes, unpacked

WIDTH = 50
#: Words of a run that may be an anchor.
RUN = 12
#: Windows of a stretch at most.
STRETCH = 64
#: Bytes of text in a group of documents, and of anchors or stretches in a shard, about.
GROUP_BYTES = 8 << 20
_NO_ID = np.int64(2**63 - 1)


def sequence_names(some: words.Words) -> np.ndarray:
    """A 64-bit name for each document's sequence of words."""
    counts = some.counts()
    n = len(some.hashes)
    power, inverse = words._power(n + 1)
    out = np.zeros(len(counts), dtype=np.uint64)
    for salt in (0, 0x51ED270B):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words.mixed(some.hashes + np.uint64(salt)) * power[:n], out=sums[1:])
        total = (sums[some.offsets[1:]] - sums[some.offsets[:-1]]) * inverse[some.offsets[:-1]]
        out = words.mixed(out + total + counts.astype(np.uint64))
    return out.view(np.int64)


def window_anchors(some: words.Words, width: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, anchor) of all windows, in order."""
    n = len(some.hashes)
    total = n - width + 1
    if total <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rolled = np.zeros(n - run + 1, dtype=np.uint64)
    for j in range(run):
        rolled += some.hashes[j : j + len(rolled)] * words._PLACES[j]
    least, reach = words.mixed(rolled), 1
    span = width - run + 1
    while 2 * reach <= span:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    owner = np.repeat(np.arange(len(some)), some.counts())
    whole = np.flatnonzero(owner[:total] == owner[width - 1 :])
    return owner[whole], whole, least[whole]


def window_hashes(some: words.Words, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on."""
    rolled = np.zeros(max(0, len(some.hashes) - width + 1), dtype=np.uint64)
    for j in range(width):
        rolled = rolled * words._BASE + some.hashes[j : j + len(rolled)]
    return words.mixed(rolled ^ np.uint64(0x51ED270B))


def window_keys(some: words.Words, width: int, run: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, key) of all windows: the anchor, or the hash of the window where that is ``common``."""
    doc, at, key = window_anchors(some, width, run)
    usual = member(key, common)
    if usual.any():
        key = np.where(usual, window_hashes(some, width)[at], key)
    return doc, at, key


def _distinct(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return key[new], doc[new]


def _set_anchors(width: int, run: int):
    def values(some: words.Words) -> tuple[np.ndarray, np.ndarray]:
        doc, _, anchor = window_anchors(some, width, run)
        return _distinct(doc, anchor)

    return values


def _set_hashes(width: int, run: int, common: np.ndarray):
    """The hashes of the windows whose anchors are ``common``."""

    def values(some: words.Words) -> tuple[np.ndarray, np.ndarray]:
        doc, at, anchor = window_anchors(some, width, run)
        usual = member(anchor, common)
        return _distinct(doc[usual], window_hashes(some, width)[at[usual]])

    return values


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False)


def joined_hash(text: str | None) -> str:
    return hashlib.sha256(b" ".join((text or "").encode().split())).hexdigest()


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        count, node = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, _, some in words.chunks(batch.column(1)):
            count.append(some.counts())
            node.append(sequence_names(some))
        whole = [joined_hash(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.concatenate(count)), pa.array(np.concatenate(node)), pa.array(whole, pa.string())],
            ["id", "n_words", "node", "whole_sha256"],
        )


class _Once:
    """Copies of a document in a task: the first, and later ones with a smaller id, are let through."""

    def __init__(self, most: int = 1_000_000) -> None:
        self.least: dict[int, int] = {}
        self.most = most

    def new(self, node: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.ones(len(node), dtype=bool)
        for i, (x, y) in enumerate(zip(node.tolist(), ids.tolist(), strict=True)):
            if x in self.least and self.least[x] <= y:
                out[i] = False
            elif x in self.least or len(self.least) < self.most:
                self.least[x] = y
        return out


def _anchors(width: int, run: int, buckets: int, common: np.ndarray, given: np.ndarray, most: int = 500_000):
    """Rows of a bucket of anchors: those not ``given``, and the documents that have them; about ``most`` at a time."""

    def deal(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        anchor, node = (np.concatenate([x[i] for x in parts]) for i in range(2))
        order, bounds = dealt(anchor >> np.uint64(20), buckets)
        rows: tuple[list, list, list] = ([], [], [])
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            at = order[bounds[k] : bounds[k + 1]]
            for x, y in zip(rows, (k, packed(anchor[at]), packed(node[at])), strict=True):
                x.append(y)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int32()), *(pa.array(x, pa.binary()) for x in rows[1:])], ["bucket", "anchors", "nodes"]
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            ids = _numbers(batch.column(0))
            for first, last, some in words.chunks(batch.column(1)):
                node = sequence_names(some)
                new = once.new(node, ids[first:last])
                doc, _, anchor = window_keys(some, width, run, common)
                change = np.ones(len(doc), dtype=bool)
                change[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
                change &= new[doc] & ~member(anchor, given)
                parts.append((anchor[change], node[doc[change]]))
                held += int(change.sum())
                if held >= most:
                    yield deal(parts)
                    parts, held = [], 0
        if held:
            yield deal(parts)

    return emit


def _several(groups: int):
    """Of a bucket of anchors those that several documents have, for each group of documents."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        anchor, node = unpacked(frame["anchors"], np.uint64), unpacked(frame["nodes"], np.int64)
        order = np.lexsort((node, anchor))
        anchor, node = anchor[order], node[order]
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (node[1:] != node[:-1])
        anchor, node = anchor[new], node[new]
        same = anchor[1:] == anchor[:-1]
        shared = np.zeros(len(anchor), dtype=bool)
        shared[1:] |= same
        shared[:-1] |= same
        anchor, node = anchor[shared], node[shared]
        order, bounds = dealt(node.view(np.uint64), groups)
        rows = [
            (k, packed(np.unique(anchor[order[bounds[k] : bounds[k + 1]]]))) for k in np.flatnonzero(np.diff(bounds)).tolist()
        ]
        return pd.DataFrame(rows, columns=["bucket", "anchors"])

    return run


def _grouped_texts(groups: int):
    """Texts with their group; copies in one task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for batch in batches:
            ids, node, count = _numbers(batch.column(0)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, some in words.chunks(batch.column(1)):
                node.append(sequence_names(some))
                count.append(some.counts())
            node, count = np.concatenate(node), np.concatenate(count)
            keep = pa.array(once.new(node, ids) & (count > 0))
            group = pa.array((node.view(np.uint64) % np.uint64(groups)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [group, pa.array(node), pa.array(ids), batch.column(1)], ["bucket", "node", "id", "text"]
            ).filter(keep)

    return run


_STRETCHES = "kind int, bucket int, source int, node long, id long, a binary, b binary, c binary, d binary, text string"


def _stretches(width: int, run: int, shards: int, common: np.ndarray, given: np.ndarray):
    """Of a group of documents: their stretches, kind 1, and, dealt out by shard, each different one, kind 0."""

    def find(key: tuple, texts: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        columns = ["kind", "bucket", "source", "node", "id", "a", "b", "c", "d", "text"]
        shared = np.union1d(unpacked(anchors["anchors"], np.uint64), given)
        texts = texts.sort_values(["node", "id"]).drop_duplicates("node").reset_index(drop=True)
        rows: list[tuple] = []
        known: dict[bytes, int] = {}
        least: list[int] = []
        found: list[tuple[int, bytes]] = []
        column = pa.array(texts["text"], pa.string())
        for first, _, some in words.chunks(column) if len(shared) else ():
            doc, at, anchor = window_keys(some, width, run, common)
            place = np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)
            cut = np.ones(len(doc), dtype=bool)
            cut[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
            run_of = np.cumsum(cut) - 1
            begin = np.flatnonzero(cut)
            cut |= (np.arange(len(doc)) - begin[run_of]) % STRETCH == 0 if len(doc) else cut
            begin = np.flatnonzero(cut)
            stop = np.append(begin[1:], len(doc))
            useful = shared[place[begin]] == anchor[begin] if len(begin) else begin.astype(bool)
            short = (some.hashes >> np.uint64(32)).astype(np.uint32)
            mine: dict[int, list[tuple[int, int]]] = {}
            for i, j in zip(begin[useful].tolist(), stop[useful].tolist(), strict=True):
                d, start = int(doc[i]), int(at[i])
                name = int(anchor[i]).to_bytes(8, "little") + short[start : start + (j - i) + width - 1].tobytes()
                number = known.setdefault(name, len(known))
                owner = int(texts["id"].iat[first + d])
                if number == len(least):
                    least.append(owner)
                    found.append((int(anchor[i]), name[8:]))
                else:
                    least[number] = min(least[number], owner)
                mine.setdefault(d, []).append((start - int(some.offsets[d]), number))
            for d, parts in mine.items():
                row = texts.iloc[first + d]
                start, number = (np.array(x, dtype=np.int64) for x in zip(*parts, strict=True))
                rows.append((1, key[0], key[0], int(row["node"]), int(row["id"]), packed(start), packed(number), b"", b"", row["text"]))
        anchor = np.array([x[0] for x in found], dtype=np.uint64)
        order, bounds = dealt(anchor >> np.uint64(20), shards)
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            some = order[bounds[k] : bounds[k + 1]]
            size = np.array([len(found[x][1]) // 4 for x in some], dtype=np.int32)
            body = b"".join(found[x][1] for x in some)
            owner = np.array([least[x] for x in some], dtype=np.int64)
            rows.append((0, k, key[0], 0, 0, packed(some.astype(np.int64)), packed(size), body, packed(owner), None))
        return pd.DataFrame(rows, columns=columns)

    return find


def _searched(width: int):
    """A shard: its index, and for each stretch's windows the least document, sent back to the groups."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        known: dict[bytes, int] = {}
        owners: list[int] = []
        place: list[list[int]] = []
        for row in frame.itertuples():
            size, at, mine = np.frombuffer(row.b, np.int32), 0, []
            for n, owner in zip(size.tolist(), np.frombuffer(row.d, np.int64).tolist(), strict=True):
                name = row.c[at : at + 4 * n]
                at += 4 * n
                k = known.setdefault(name, len(known))
                if k == len(owners):
                    owners.append(owner)
                else:
                    owners[k] = min(owners[k], owner)
                mine.append(k)
            place.append(mine)
        found = least_owners([np.frombuffer(x, np.uint32) for x in known], np.array(owners, dtype=np.int64), width)
        rows = []
        for row, mine in zip(frame.itertuples(), place, strict=True):
            rows.append((row.source, row.a, row.b, packed(np.concatenate([found[k] for k in mine]))))
        return pd.DataFrame(rows, columns=["bucket", "numbers", "sizes", "least"])

    return run


def covered(start: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words are in a window that begins at one of ``start``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + width, n), -1)
    return np.cumsum(edge[:n]) > 0


def _removed(width: int):
    """Of a group of documents, those that lose words: how many, and what stays."""

    def run(key: tuple, documents: pd.DataFrame, results: pd.DataFrame) -> pd.DataFrame:
        least: dict[int, np.ndarray] = {}
        for row in results.itertuples():
            numbers, size = np.frombuffer(row.numbers, np.int64), np.frombuffer(row.sizes, np.int32)
            values = np.frombuffer(row.least, np.int64)
            ends = np.cumsum(size - width + 1)
            for k, lo, hi in zip(numbers.tolist(), (ends - (size - width + 1)).tolist(), ends.tolist(), strict=True):
                least[k] = values[lo:hi]
        out = []
        for row in documents.itertuples():
            start, number = np.frombuffer(row.a, np.int64), np.frombuffer(row.b, np.int64)
            hit = [s + np.flatnonzero(least[k] < row.id) for s, k in zip(start.tolist(), number.tolist(), strict=True)]
            hit = np.concatenate(hit)
            if len(hit):
                own = row.text.encode().split()
                gone = covered(hit, width, len(own))
                left = b" ".join(own[i] for i in np.flatnonzero(~gone).tolist())
                out.append((row.node, int(gone.sum()), hashlib.sha256(left).hexdigest()))
        return pd.DataFrame(out, columns=["node", "n_removed", "kept_sha256"])

    return run


def repeated_words(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    run: int = RUN,
    group_bytes: int = GROUP_BYTES,
    common_share: float = SHARE,
    common_sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: id, n_words, n_removed and kept_sha256, the hash of the words that stay.

    Ids are whole numbers. A null text has no words. A null id comes after all others; rows with
    one id take nothing from each other. Documents of fewer than ``width`` words lose nothing. Words
    are compared by 64-bit hashes of ``run`` words in anchors, of all words in windows of a common
    anchor, and by 32 bits each in stretches.
    """
    run = min(run, width)
    slim = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sequences = kept(
        slim.mapInArrow(_sequences, "id long, n_words long, node long, whole_sha256 string"), "sequences"
    )
    volume = text_bytes(slim, "text")
    groups = max(8, volume // group_bytes + 1)
    common = common_values(slim, "id", "text", _set_anchors(width, run), False, common_share, common_sample)
    given = common
    if len(common):
        given = common_values(slim, "id", "text", _set_hashes(width, run, common), False, common_share, common_sample)
    shared = (
        slim.mapInArrow(_anchors(width, run, groups, common, given), "bucket int, anchors binary, nodes binary")
        .groupBy("bucket")
        .applyInPandas(_several(groups), "bucket int, anchors binary")
    )
    texts = slim.mapInArrow(_grouped_texts(groups), "bucket int, node long, id long, text string")
    stretches = kept(
        texts.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInPandas(
            _stretches(width, run, groups, common, given), _STRETCHES
        ),
        "stretches",
    )
    shards = stretches.where("kind = 0").select("bucket", "source", "a", "b", "c", "d")
    results = shards.groupBy("bucket").applyInPandas(
        _searched(width), "bucket int, numbers binary, sizes binary, least binary"
    )
    removed = kept(
        stretches.where("kind = 1")
        .select("bucket", "node", "id", "a", "b", "text")
        .groupBy("bucket")
        .cogroup(results.groupBy("bucket"))
        .applyInPandas(_removed(width), "node long, n_removed long, kept_sha256 string"),
        "removed",
    )
    order = F.coalesce("id", F.lit(int(_NO_ID)))
    first = sequences.groupBy("node").agg(F.min(order).alias("first"))
    of_node = kept(first.join(removed, "node", "left"), "of-node")
    copy = (F.col("n_words") >= width) & (order > F.col("first"))
    return sequences.join(of_node, "node").select(
        "id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(joined_hash(None))).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )
