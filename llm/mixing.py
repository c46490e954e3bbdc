"""Mixing sources to target weights: whole copies and one seeded draw for the rest.

The words of each source are counted, its target gives its repetition rate, and each document
comes out floor(rate) times and once more with a probability of the rate's fraction, drawn from
a hash of its id and the seed, so that reruns and lost executors change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.graph import as_struct, kept
from llm.words import WORD

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: A source is taken this many times at most.
MOST = 3
#: Up to so many sources (some tens of bytes each) their rates are broadcast; beyond it they are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def word_count(text: str | Column) -> Column:
    """Words of a text, as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) for a table (source, size) of documents.

    The sources, by code point with null last, weigh ``weights``, repeating, and share all
    words. Where a share would be above ``most`` times its source's size it stops there, and the
    rest is shared by weight among the others: with a level, the words per unit of weight, each
    target is min(most * size, level * weight). Sources are put in the order in which they
    reach their bound. If all before one of them are at theirs, the rest of the words over the rest
    of the weights is a level; it grows as long as sources stop and falls after that, so that the
    largest is the one that uses up all words.

    Its windows see a row per source, after partial sums: never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").cast("long").alias("source_size"))
        .withColumn("at", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.array(*[F.lit(float(w)) for w in weights])[F.col("at") % len(weights)])
        .withColumn("bound", F.col("source_size") * float(most))
    )
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), "at")
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(
        by_bound.rowsBetween(0, Window.unboundedFollowing)
    )
    return (
        sources.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source",
            "source_size",
            F.least("bound", F.col("level") * F.col("weight")).alias("target"),
        )
    )


def copies(rate: Column, id: Column, seed: int) -> Column:
    """floor(rate), and one more with the probability of the fraction."""
    named = F.concat_ws(":", F.lit(str(seed)), id.cast("string"))
    draw = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("long")


def _rated(docs: DataFrame, targets: DataFrame, source: str, most: float) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``rate`` of their sources."""
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    rates = targets.select(
        F.col("source").alias("rated_source"), "source_size", "target", F.coalesce(rate, F.lit(1.0)).alias("rate")
    )
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    return docs.join(rates, F.col(source).eqNullSafe(F.col("rated_source")), "left")


def mixed_sizes(
    docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 1,
    weights: tuple[int, ...] = WEIGHTS, most: float = MOST,
) -> DataFrame:
    """One row per document: id, size, source_size, target and taken, the words that the mix takes of it.

    A null or empty text has no words; a source without words has the target 0; equal ids are
    drawn alike; a null id is drawn like any other. An empty table gives none.
    """
    sized = kept(docs.select(F.col(id).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")), "sized")
    targets = kept(source_targets(sized, weights, most), "targets")
    return _rated(sized, targets, "source", most).select(
        "id", "size", "source_size", "target", (F.col("size") * copies(F.col("rate"), F.col("id"), seed)).alias("taken")
    )


def mixed_documents(
    docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 1,
    weights: tuple[int, ...] = WEIGHTS, most: float = MOST,
) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Documents of a source that has no words at all come once.
    """
    sized = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    targets = kept(source_targets(sized, weights, most), "targets")
    times = copies(F.col("rate"), F.col(f"doc.{id}"), seed).cast("int")
    rated = _rated(as_struct(docs, "doc"), targets, f"doc.{source}", most)
    return rated.select("doc", F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).select("doc.*")
