"""Line deduplication by content-defined chunks of lines.

A rolling hash over the last ``window`` line hashes ends a chunk where it is divisible by
``spacing``, so that lines inserted elsewhere move no boundary. A chunk of several lines that
an earlier document has too is removed, and so is its repetition within a document; single
lines stay. Chunks are equal when their bytes are: a chunk is known by a 128-bit hash, and the
texts themselves are compared wherever a hash is counted; a hash that two different texts
share removes nothing.

With ``spacing`` 1 each window of lines ends a chunk and is one itself. Such chunks overlap, and those that are
repeated make up each repeated run of at least ``window`` lines from its first line to its last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.graph import as_struct, kept

WINDOW = 2
#: Up to so many removed chunks (8 bytes each, and some tens for a document) are broadcast; more are joined by a shuffle.
BROADCAST_SPANS = 1_000_000
SPACING = 4
#: Every window is a chunk: no repeated run is missed.
DENSE = 1


def _ends(hashes: Column, window: int, spacing: int) -> Column:
    """The positions of the last lines of the chunks."""
    last = F.size(hashes) - 1

    def rolled(i: Column) -> Column:
        terms = [F.get(hashes, i - j).bitwiseXOR(F.lit(j * 0x5851F42D)) for j in range(window)]
        # a boundary needs a whole window of lines before it
        return F.pmod(F.xxhash64(*terms), F.lit(spacing)) == 0

    return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | ((i >= window - 1) & rolled(i)))


def line_chunks(docs: DataFrame, text: str = "text", window: int = WINDOW, spacing: int = SPACING) -> DataFrame:
    """``docs`` with ``_lines`` and ``_spans``, arrays of the chunks' places: first line * 2^32 + number of lines."""
    return (
        docs.withColumn("_lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
        .withColumn("_hashes", F.transform("_lines", lambda x: F.xxhash64(x)))
        .withColumn("_ends", _ends(F.col("_hashes"), window, spacing))
        .withColumn(
            "_spans",
            F.transform(
                "_ends",
                lambda end, i: (F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_ends"), i - 1) + 1).cast("long") * (1 << 32))
                + end.cast("long")
                - F.when(i == 0, F.lit(-1)).otherwise(F.get(F.col("_ends"), i - 1)).cast("long"),
            ),
        )
        .drop("_hashes", "_ends")
    )


def _lone_lines(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_lines`` and ``_spans`` as from :func:`line_chunks`, a place for each line."""
    return docs.withColumn("_lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n")).withColumn(
        "_spans", F.transform("_lines", lambda x, i: i.cast("long") * (1 << 32) + 1)
    )


def _slice(lines: Column, span: Column) -> Column:
    return F.slice(lines, (F.shiftright(span, 32) + 1).cast("int"), span.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))


def _chunks(docs: DataFrame, id: str, text: str, window: int, spacing: int) -> DataFrame:
    """A row for each chunk of several lines: document, a hash of its text, place, chunk and its two hashes."""
    spans = F.filter("_spans", lambda s: s.bitwiseAND(F.lit((1 << 32) - 1)) > 1)
    return (
        line_chunks(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "text", window, spacing)
        .withColumn("whole", F.xxhash64("text"))
        .withColumn("span", F.explode(spans))
        .withColumn("chunk", F.array_join(_slice(F.col("_lines"), F.col("span")), "\n"))
        .select(
            "id", "whole", "span", "chunk", F.xxhash64("chunk").alias("h1"), F.xxhash64("chunk", F.lit(1)).alias("h2")
        )
    )


def _dense_spans(docs: DataFrame, id: str, text: str, window: int) -> DataFrame:
    """(id, whole, spans) like :func:`repeated_spans`, a span for each line that is in a repeated window of lines.

    A window stays where the smallest id that has it has it first; in that document its repetitions go
    that don't overlap this place. A line that two different texts' hash stands for is in no window.
    """
    lines = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).withColumn("lines", F.split("text", "\n"))
    several = lines.where(F.size("lines") >= window)
    names = ["h1", "h2"]
    texts = several.select(F.explode("lines").alias("line")).select(
        F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2"), "line"
    )
    shared = texts.distinct().groupBy(*names).agg(F.count("*").alias("texts")).where("texts > 1")
    shared = kept(shared.select(*names), "shared-hashes")
    hashed = several.select(
        "id",
        F.xxhash64("text").alias("whole"),
        F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(x, F.lit(1)).alias("h2"))).alias("hashes"),
    )
    starts = F.size("hashes") - (window - 1)
    windows = F.arrays_zip(*[F.slice("hashes", j + 1, starts).alias(f"l{j}") for j in range(window)])
    keys = [f"l{j}_{h}" for j in range(window) for h in names]
    places = hashed.select("id", "whole", F.posexplode(windows).alias("at", "w")).select(
        "id", "whole", "at", *[F.col("w")[f"l{j}"][h].alias(f"l{j}_{h}") for j in range(window) for h in names]
    )
    if shared.take(1):
        for j in range(window):
            places = places.join(shared.select(*[F.col(h).alias(f"l{j}_{h}") for h in names]), keys[2 * j : 2 * j + 2], "left_anti")
    known = places.groupBy(*keys).agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    known = kept(known.select(*keys, "first"), "windows")
    own = F.col("first").isNull() | F.col("id").eqNullSafe(F.col("first"))
    per_window = (
        places.join(known, keys)
        .groupBy("id", "whole", own.alias("own"), *keys)
        .agg(F.collect_set("at").alias("places"), F.min("at").alias("least"))
    )
    gone = F.filter("places", lambda at: ~F.col("own") | (at >= F.col("least") + window))
    spans = F.transform(
        F.flatten(F.transform(gone, lambda at: F.sequence(at, at + (window - 1)))), lambda at: at.cast("long") * (1 << 32) + 1
    )
    per_doc = per_window.groupBy("id", "whole").agg(F.collect_list(spans).alias("spans"))
    return per_doc.select("id", "whole", F.array_distinct(F.flatten("spans")).alias("spans")).where(F.size("spans") > 0)


def repeated_spans(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, spacing: int = SPACING
) -> DataFrame:
    """(id, whole, spans): of each document the places of the chunks to remove; ``whole`` is the text's hash.

    A chunk stays where the smallest id that has it has it first. Documents with one id keep
    their chunks from each other; a document with a null id comes after all others, and keeps what
    only such documents have. With ``spacing`` 1 the places are those of single lines.
    """
    if spacing == DENSE:
        return _dense_spans(docs, id, text, window)
    chunks = _chunks(docs, id, text, window, spacing)
    texts = chunks.groupBy("h1", "h2", "chunk").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    known = (
        texts.groupBy("h1", "h2")
        .agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.sum("n").alias("n"))
        .where("texts = 1 AND n > 1")
    )
    known = kept(known.select("h1", "h2", "first"), "chunks")
    places = chunks.select("id", "whole", "span", "h1", "h2")
    found = places.join(known, ["h1", "h2"])
    own = F.col("first").isNull() | F.col("id").eqNullSafe(F.col("first"))
    per_doc = found.groupBy("id", "whole").agg(
        F.collect_set(F.when(~own, F.col("span"))).alias("others"),
        F.collect_set(F.when(own, F.struct("h1", "h2", "span"))).alias("own"),
    )
    # of the chunks that the document itself has first, the first place of each stays
    firsts = F.transform(
        F.filter(
            F.transform(F.array_sort("own"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
            lambda y: (y.i > 0)
            & (F.get(F.array_sort("own"), y.i - 1).h1 == y.x.h1)
            & (F.get(F.array_sort("own"), y.i - 1).h2 == y.x.h2),
        ),
        lambda y: y.x.span,
    )
    return per_doc.select("id", "whole", F.array_union("others", firsts).alias("spans")).where(F.size("spans") > 0)


def _cut(docs: DataFrame, id: str, text: str, window: int, spacing: int) -> DataFrame:
    """doc, lines, removed (places, or null) and kept: the text without them, left as it is if it loses nothing."""
    spans = kept(repeated_spans(docs, id, text, window, spacing), "spans").select(
        F.col("id").alias("of"), "whole", F.col("spans").alias("removed")
    )
    if (spans.agg(F.sum(F.size("removed"))).first()[0] or 0) <= BROADCAST_SPANS:
        spans = F.broadcast(spans)
    else:
        spans = spans.hint("merge")
    body = F.col(f"doc.{text}")
    same = (F.xxhash64(body) == F.col("whole")) & F.col(f"doc.{id}").eqNullSafe(F.col("of"))
    joined = as_struct(docs, "doc").join(spans, same, "left").select("doc", "removed", body.alias("body"))
    lines = F.flatten(F.transform(F.array_except("_spans", "removed"), lambda s: _slice(F.col("_lines"), s)))
    left = F.when(F.col("removed").isNull(), F.col("body")).otherwise(F.array_join(lines, "\n"))
    chunked = _lone_lines(joined, "body") if spacing == DENSE else line_chunks(joined, "body", window, spacing)
    return chunked.select("doc", F.col("_lines").alias("lines"), "removed", left.alias("kept"))


def deduplicated_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, spacing: int = SPACING
) -> DataFrame:
    """The documents with the repeated chunks cut out of ``text`` and all other columns unchanged.

    No row is dropped: a document that loses all its lines has an empty text. A null text stays null.
    """
    frame = _cut(docs, id, text, window, spacing)
    return frame.select(*[F.col("kept").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def line_report(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, spacing: int = SPACING
) -> DataFrame:
    """One row per document: id, its lines, how many of them go, and the SHA-256 of the text that stays."""
    frame = _cut(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "id", "text", window, spacing)
    gone = F.aggregate(
        F.coalesce("removed", F.array().cast("array<bigint>")),
        F.lit(0).cast("long"),
        lambda n, s: n + s.bitwiseAND(F.lit((1 << 32) - 1)),
    )
    return frame.select(
        "doc.id",
        F.when(F.col("doc.text").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        gone.alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
