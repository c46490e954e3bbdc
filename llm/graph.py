"""Connected components of a link table, and the arrays that move between tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.shared import scratch_path, written_table

LINKS = "a long, b long"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends here."""
    return written_table(df, scratch_path(df.sparkSession, name))


def as_struct(df: DataFrame, name: str) -> DataFrame:
    """All columns in one, so that no other name can clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between ids: the ids that are not the smallest of their component, and that smallest id."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(len(ids))
    left, right = at[: len(a)], at[len(a) :]
    while True:
        low, high = np.minimum(parent[left], parent[right]), np.maximum(parent[left], parent[right])
        if (low == high).all():
            break
        np.minimum.at(parent, high, low)
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
    other = parent != np.arange(len(ids))
    return ids[other], ids[parent[other]]


def _contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the links of a task by a forest of as few; batches are merged as they come."""
    a = b = np.zeros(0, dtype=np.int64)
    for frame in frames:
        a, b = forest(np.concatenate([a, frame["a"].to_numpy()]), np.concatenate([b, frame["b"].to_numpy()]))
    yield pd.DataFrame({"a": a, "b": b})


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one link to a smaller one, or only links from larger ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"))
    )
    seen = ends.groupBy("node").agg(F.sum("down").alias("down"), F.min("down").alias("least"))
    return not seen.where("down > 1 OR (down = 1 AND least = 0)").take(1)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Large-star and small-star rounds in turn until all links lead straight to the smallest node,
    over links that each task has first made into a forest. A node with very many links is joined on both sides of a
    shuffle that Spark can split, and minima combine before they are shuffled. Links with a
    null end and from a node to itself are left out; without links the result is empty.
    """
    # written first, so that a task has one Python worker, not one for the links and one for the forest
    links = kept(links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b"), "links")
    edges = kept(links.mapInPandas(_contract, LINKS).distinct(), "forest")
    while not _settled(edges):
        edges = kept(_star(edges, large=True), "large-star")
        edges = kept(_star(edges, large=False), "small-star")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Move each node's links to the smallest of its neighbours and itself; edges go from larger to smaller."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "lowest")
        moved = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        lowest = kept(edges.groupBy("a").agg(F.min("b").alias("low")), "lowest")
        moved = edges.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.unionByName(lowest.select("a", F.col("low").alias("b")))
    return moved.where("a <> b").distinct()


def dealt(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings the entries of a bucket together, and where each bucket begins."""
    at = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    return order, np.searchsorted(at[order], np.arange(buckets + 1))


def packed(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def unpacked(blobs, kind) -> np.ndarray:
    """The arrays of several binary cells, one after the other."""
    found = [np.frombuffer(x, dtype=kind) for x in blobs]
    return np.concatenate(found) if found else np.zeros(0, dtype=kind)


def text_bytes(docs: DataFrame, text: str) -> int:
    """All bytes of the text column: what the number of buckets is made from."""
    return docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
