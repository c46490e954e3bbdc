"""Source divergence audit on run-length columns.

Within a language each source is a column of counts over the kept vocabulary. The vocabulary is put
in an order that brings terms of equal counts together and cut into blocks; in a block each column
is a few runs of equal counts. Two sources are compared by the boundaries of both columns' runs:
between two boundaries both counts stand still, so the divergence of one term is worked out once
and multiplied by the number of terms. All arithmetic is in whole numbers.

A block is bounded by its number of counts, and the sources of a block are compared tile by tile, so a
task's work is bounded however large the vocabulary, and however many the sources are.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.graph import kept

#: A term is a run of what is left of a text's UTF-8 bytes between blanks: [^\x00-\x40\x5B-\x60\x7B-\x7F]+ with A-Z lower-cased.
_PLAIN = bytes(b if b >= 128 or chr(b) in string.ascii_letters else 32 for b in range(256)).lower()
#: Different terms that a task counts at a time, about; bytes of a text that it takes apart at a time; rows it hands on at a time.
HELD = 200_000
STRETCH = 1 << 20
_ROWS = 20_000
#: Probabilities are whole numbers of this many parts.
PARTS = 1_000_000_000
#: Counts in a block of the vocabulary, about.
BLOCK = 100_000
#: Sources in a tile, about.
TILE = 128


def scaled(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(PARTS * (count + 2) / total), digit by digit, so that no product leaves 64 bits."""
    out, rest = np.divmod(count.astype(np.int64) + 2, np.int64(total))
    for _ in range(len(str(PARTS)) - 1):
        digit, rest = np.divmod(rest * 10, np.int64(total))
        out = out * 10 + digit
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _share(count: str, total: str) -> Column:
    """The same as :func:`scaled`, of two columns."""
    return F.expr(f"1L + (CAST({count} AS DECIMAL(19,0)) + 2) * {PARTS}BD div CAST({total} AS DECIMAL(20,0))")


def _stretches(text: bytes, most: int) -> Iterator[list[bytes]]:
    """The terms of a text, those of about ``most`` bytes at a time; a term is a run of letters and all that is not ASCII, in lower case."""
    try:
        text.decode()
    except UnicodeDecodeError:
        text = text.decode("utf-8", "replace").encode()
    start, plain = 0, text.translate(_PLAIN)
    while start < len(plain):
        end = plain.find(b" ", start + most)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def _counted(most: int, stretch: int):
    """For batches of (lang, source, text): (lang, source, term, n, docs), ``most`` terms of all groups held at a time, or one document's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = 0, defaultdict(lambda: (Counter(), Counter()))

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in counts.items():
                terms = list(n)
                columns = [pa.repeat(pa.scalar(x, pa.binary()), len(terms)) for x in (lang, source)]
                columns += [pa.array(terms, pa.binary())]
                columns += [pa.array(map(c.__getitem__, terms), pa.int64()) for c in (n, docs)]
                whole = pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
                yield from (whole.slice(at, _ROWS) for at in range(0, len(whole), _ROWS))

        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                n, docs = counts[lang, source]
                before, own = len(n), set()
                for terms in _stretches(text, stretch):
                    n.update(terms)
                    own.update(terms)
                docs.update(own)
                held += len(n) - before
                if held >= most:
                    yield from rows()
                    held = 0
                    counts.clear()
        yield from rows()

    return run


def term_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", most: int = HELD, stretch: int = STRETCH
) -> DataFrame:
    """(lang, source, term, n, docs): how often a term occurs in the texts of a group, and in how many of them.

    Each task counts the terms of its documents, ``most`` different ones at a time, and these counts are summed before they are
    shuffled: a group with a third of all rows is as many rows as there are tasks and terms.
    """
    # as bytes, which no step on the way checks or changes
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = plain.mapInArrow(_counted(most, stretch), "lang binary, source binary, term binary, n long, docs long")
    names = [F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")]
    return counted.select(*names, "n", "docs").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _vocabulary(counts: DataFrame, least: int) -> DataFrame:
    """(lang, term, n, cells): the kept terms with their counts by source; a row has at most as many cells as there are sources."""
    cells = F.array_sort(F.collect_list(F.struct("source", "n")))
    grouped = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), cells.alias("cells"))
    return grouped.where(F.col("docs") >= least).select("lang", "term", "n", "cells")


def _runs(frame: pd.DataFrame) -> pd.DataFrame:
    """The columns of a block: for each source where its runs of equal counts begin, and their counts."""
    lang, block = frame["lang"].iloc[0], frame["block"].iloc[0]
    frame = frame.sort_values("place", kind="stable")
    sources, starts, counts = [], [], []
    for source, part in frame.groupby("source", sort=False):
        place, n = part["place"].to_numpy(), part["n"].to_numpy()
        # a count and, unless its neighbour has one too, the gap of zeros after it
        at = np.concatenate([[0], np.stack([place, place + 1], axis=1).ravel()])
        value = np.concatenate([[0], np.stack([n, np.zeros_like(n)], axis=1).ravel()])
        last = np.ones(len(at), dtype=bool)  # of several values for one place the last one holds
        last[:-1] = at[1:] != at[:-1]
        at, value = at[last], value[last]
        change = np.ones(len(at), dtype=bool)
        change[1:] = value[1:] != value[:-1]
        sources.append(source)
        starts.append(at[change])
        counts.append(value[change])
    return pd.DataFrame({"lang": lang, "block": block, "source": sources, "starts": starts, "counts": counts})


def _compared(frame: pd.DataFrame) -> pd.DataFrame:
    """The divergences of the sources of two tiles (or within one) over the terms of a block."""
    first = frame.iloc[0]
    left, right, size = int(first["left"]), int(first["right"]), int(first["size"])
    columns = []
    for row in frame.sort_values("source").itertuples(index=False):
        starts = np.asarray(row.starts, dtype=np.int64)
        shares = scaled(np.asarray(row.counts, dtype=np.int64), row.total) if row.total else np.zeros(len(starts), np.int64)
        columns.append((row.source, row.own, starts, shares))
    rows = [c for c in columns if c[1] == left]
    others = [c for c in columns if c[1] == right]
    a, b, value = [], [], []
    for source, _, starts, shares in rows:
        for other, _, others_starts, others_shares in others:
            if left == right and source >= other:
                continue
            a.append(source)
            b.append(other)
            if not size:
                value.append(0)
                continue
            bounds = np.union1d(starts, others_starts)
            bounds = bounds[bounds < size]
            p = shares[np.searchsorted(starts, bounds, "right") - 1]
            q = others_shares[np.searchsorted(others_starts, bounds, "right") - 1]
            value.append(int((divergence(p, q) * np.diff(np.append(bounds, size))).sum()))
    texts = {name: pd.Series(x, dtype=object) for name, x in (("lang", [first["lang"]] * len(a)), ("a", a), ("b", b))}
    return pd.DataFrame({**texts, "value": np.array(value, dtype=np.int64)})


def _pairs(terms: DataFrame, groups: DataFrame, block: int, tile: int) -> DataFrame:
    """(lang, a, b, value) for each two sources of a language."""
    cells = terms.agg(F.sum(F.size("cells"))).first()[0] or 0
    blocks = int(cells // block) + 1
    # terms with the same counts in the same sources come one after the other
    ordered = kept(
        terms.select("lang", "cells", "term").repartitionByRange(blocks, "lang", "cells", "term").withColumn("block", F.spark_partition_id()),
        "blocks",
    )
    by_counts = Window.partitionBy("lang", "block").orderBy("cells", "term")
    placed = ordered.withColumn("place", (F.row_number().over(by_counts) - 1).cast("long"))
    runs = (
        placed.select("lang", "block", "place", F.explode("cells").alias("cell"))
        .select("lang", "block", "place", "cell.source", "cell.n")
        .groupBy("lang", "block")
        .applyInPandas(_runs, "lang string, block int, source string, starts array<long>, counts array<long>")
    )
    sizes = ordered.groupBy("lang", "block").agg(F.count("*").alias("size"))
    # every source has a column in every block, and a language without terms one block of none
    whole = groups.join(sizes, "lang", "left").select(
        "lang", F.coalesce("block", F.lit(-1)).alias("block"), F.coalesce("size", F.lit(0)).alias("size"), "source", "total", "sources"
    )
    zeros = F.array(F.lit(0).cast("long"))
    columns = kept(
        whole.join(runs, ["lang", "block", "source"], "left").select(
            "lang", "block", "size", "source", "total", F.coalesce("starts", zeros).alias("starts"),
            F.coalesce("counts", zeros).alias("counts"), F.ceil(F.col("sources") / tile).cast("int").alias("tiles"),
        ),
        "columns",
    )
    dealt = (
        columns.withColumn("own", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumns({"left": F.least("own", "other"), "right": F.greatest("own", "other")})
        .drop("tiles", "other")
    )
    compared = dealt.groupBy("lang", "block", "left", "right").applyInPandas(_compared, "lang string, a string, b string, value long")
    return compared.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = 10,
    top: int = 10,
    block: int = BLOCK,
    tile: int = TILE,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language use its words differently.

    A language keeps the terms that at least ``least`` of its documents have. Part ``pair``: each other source of the
    language with the divergence summed over all kept terms, 0 if there are none. Part ``term``: the
    ``top`` terms that the group has more often than the language, by their divergence from it. Ranks go
    by descending value, then by the item's UTF-8 bytes.

    Null texts, languages and sources are read as empty ones, and so a group of their own; a group without terms has
    pairs only. Repeated rows count as often as they are there. A language with one source has no pairs; an
    empty table gives no rows. Texts of any length are counted whole. Counts
    go up to about 4 * 10^17 in a language.
    """
    slim = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    counts = kept(term_counts(slim), "term-counts")
    terms = kept(_vocabulary(counts, least), "vocabulary")
    everyone = slim.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    languages = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("n"))
    used = terms.select("lang", F.explode("cells").alias("cell")).groupBy("lang", F.col("cell.source").alias("source"))
    per_lang = everyone.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = kept(
        everyone.join(per_lang, "lang")
        .join(languages, "lang", "left")
        .join(used.agg(F.sum("cell.n").alias("own")), ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            "sources",
            (F.coalesce("own", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("total"),
            (F.coalesce("n", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("lang_total"),
        ),
        "groups",
    )
    compared = kept(_pairs(terms, groups, block, tile), "pairs")
    pairs = compared.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        compared.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    shares = (
        terms.select("lang", "term", F.col("n").alias("all"), F.explode("cells").alias("cell"))
        .select("lang", "term", "all", "cell.source", "cell.n")
        .join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), _share("n", "total").alias("p"), _share("`all`", "lang_total").alias("q"))
        .where("p > q")
        .select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    )
    best = shares.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("rank", F.row_number().over(ranked))
        .withColumn("part", F.lit("pair"))
        .select(*columns)
        .unionByName(best.withColumn("part", F.lit("term")).select(*columns))
    )
