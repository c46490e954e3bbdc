"""Centroid clustering with lower bounds from Ptolemy's inequality.

For four points x, c, p, s of a Euclidean space d(x,c) d(p,s) >= |d(x,p) d(c,s) - d(x,s) d(c,p)|. A few
vectors are pivots; each vector's distances to them are worked out once and kept beside it. In each
round a centroid's distances to the pivots then bound its distance to any vector from below, by all
pairs of pivots. The centroid with the least bound is measured first; another one is measured only
if its bound, rounded down, doesn't exceed the least distance known so far.

Components are whole numbers and all distances and sums are exact, so that rounds, ties and results
don't depend on how the vectors are dealt out. A round is a map over the vectors' table: a task
hands on a count and a sum for each centroid, nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.graph import kept

#: Pivots, and vectors that they are chosen from: the ones with the smallest hashes.
PIVOTS, FROM = 5, 64
#: Components up to this size have squared distances and differences within 64 bits.
LARGEST = 1 << 27
#: What floating-point numbers may be wrong by, many times over.
SLACK = 2.0**-40


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to ``c``."""
    diff = x - c
    return np.einsum("ij,ij->i", diff, diff)


def spread(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Up to ``pivots`` different vectors of the sample, each the farthest from those before it."""
    chosen = [sample[0]]
    least = squared(sample, sample[0])
    while len(chosen) < pivots and least.max() > 0:
        chosen.append(sample[int(least.argmax())])
        least = np.minimum(least, squared(sample, chosen[-1]))
    return np.stack(chosen)


class Nearest:
    """The centroids of a round with their distances to the pivots."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray) -> None:
        self.centroids = centroids
        n = len(pivots)
        self.pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
        self.between = np.array([float(squared(pivots[i : i + 1], pivots[j])[0]) ** 0.5 for i, j in self.pairs])
        self.own = np.sqrt(np.stack([squared(centroids, p) for p in pivots], axis=1).astype(np.float64))

    def bounds(self, cached: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, never above them: a row a vector, a column a centroid."""
        far = np.sqrt(cached.astype(np.float64))
        out = np.zeros((len(far), len(self.centroids)))
        for (i, j), between in zip(self.pairs, self.between, strict=True):
            left = far[:, i][:, None] * self.own[:, j][None, :]
            right = far[:, j][:, None] * self.own[:, i][None, :]
            low = (np.abs(left - right) - (left + right) * SLACK) * ((1 - SLACK) / between)
            np.maximum(out, low, out=out)
        return out * out * (1 - SLACK)

    def __call__(self, x: np.ndarray, cached: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each vector the nearest centroid (the smaller number if two are) and its squared distance; how many were measured."""
        bounds = self.bounds(cached)
        cluster = bounds.argmin(axis=1)
        diff = x - self.centroids[cluster]
        best = np.einsum("ij,ij->i", diff, diff)
        measured = len(x)
        first = cluster.copy()
        for k, centroid in enumerate(self.centroids):
            left = np.flatnonzero((bounds[:, k] <= best.astype(np.float64) * (1 + SLACK)) & (first != k))
            if not len(left):
                continue
            measured += len(left)
            found = squared(x[left], centroid)
            better = (found < best[left]) | ((found == best[left]) & (k < cluster[left]))
            cluster[left[better]] = k
            best[left[better]] = found[better]
        return cluster, best, measured


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _with_pivots(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), pivots.shape[1])
            far = np.stack([squared(x, p) for p in pivots], axis=1)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(pivots))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(far.ravel()))], ["id", "v", "far"])

    return run


def _sums(nearest: Nearest, width: int):
    """For each centroid the count and the sums of the vectors nearest to it, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(nearest.centroids)
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, width), dtype=np.int64)
        measured = 0
        for batch in batches:
            x = _matrix(batch.column(0), width)
            cluster, _, some = nearest(x, _matrix(batch.column(1), len(nearest.own[0])))
            measured += some
            count += np.bincount(cluster, minlength=k)
            for c in range(k):
                total[c] += x[cluster == c].sum(axis=0)
        frame = pd.DataFrame({"cluster": np.arange(k, dtype=np.int32), "n": count, "measured": measured, "sums": list(total)})
        yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return run


def _assigned(nearest: Nearest, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, best, _ = nearest(_matrix(batch.column(1), width), _matrix(batch.column(2), len(nearest.own[0])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(best)], ["id", "cluster", "distance"])

    return run


def _moved(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floor of the mean of their vectors; one without vectors stays."""
    width = centroids.shape[1]
    parts = stored.select("v", "far").mapInArrow(
        _sums(Nearest(centroids, pivots), width), "cluster int, n long, measured long, sums array<long>"
    )
    exact = [F.sum(F.get("sums", i).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).where("n > 0").collect():
        out[row[0]] = [int(total) // int(row[1]) for total in row[2:]]
    return out


def clustered(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    clusters: int = 8,
    rounds: int = 10,
    components: int = 64,
    scale: int = 1024,
    salt: str = "3",
    pivots: int = PIVOTS,
) -> DataFrame:
    """One row per vector of ``components`` finite components: id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    A component x counts as floor(scale * x). The centroids begin as the vectors whose ids have the smallest SHA-256
    of ``salt:id``. Each of the ``rounds`` assigns every vector to its nearest centroid (the smaller number if two are) and
    moves each centroid to the floor of its vectors' mean, one without vectors staying; then they are assigned once
    more. Null vectors, other lengths and null or non-finite components are left out. Rows with one id count
    each; as centroids they come in the order of their components. A null id is clustered, and begins a centroid only
    if too few vectors have ids. Fewer vectors than clusters make as many centroids. An empty table gives
    no rows. Components of more than 2^27 after scaling, whose distances need more than 64 bits, are an error.
    """
    values = F.col("vector")
    usable = (F.size(values) == components) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .where(usable)
        .withColumn("largest", F.array_max(F.transform("vector", lambda x: F.abs(x * scale))))
    )
    within = lambda x: F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    whole = kept(
        rows.select("id", F.transform("vector", lambda x: F.floor(within(x)).cast("int")).alias("v"), "largest"), "whole-vectors"
    )
    if (whole.agg(F.max("largest")).first()[0] or 0) >= LARGEST:
        raise ValueError(f"components must be below {LARGEST} after scaling")
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    sample = whole.select(order.alias("o"), "v").orderBy(F.col("o").asc_nulls_last(), "v").limit(max(FROM, clusters)).collect()
    if not sample:
        empty = "cast(null as int) cluster, 0L distance, 0L cluster_inertia, 0L inertia, '' centroid_sha256"
        return whole.where("false").selectExpr("id", *empty.split(", "))
    sample = np.array([r[1] for r in sample], dtype=np.int64)
    chosen = spread(sample, pivots)
    kind = whole.schema["id"].dataType.simpleString()
    stored = kept(whole.select("id", "v").mapInArrow(_with_pivots(chosen), f"id {kind}, v array<int>, far array<long>"), "vectors-pivots")
    centroids = sample[:clusters]
    for _ in range(rounds):
        moved = _moved(stored, centroids, chosen)
        if (moved == centroids).all():  # all later rounds would do the same
            break
        centroids = moved
    found = stored.mapInArrow(_assigned(Nearest(centroids, chosen), components), f"id {kind}, cluster int, distance long")
    found = kept(found, "clusters")
    sums = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    own = F.array(*[F.lit(sums.get(c, 0)).cast("long") for c in range(len(centroids))])
    names = F.array(*[F.lit(d) for d in digests])
    return found.select(
        "id",
        "cluster",
        "distance",
        F.get(own, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        F.get(names, F.col("cluster")).alias("centroid_sha256"),
    )
