"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Unit vectors are centred, turned into their principal axes and rotated so that their signs
quantise them with the least error and cut the data evenly (iterative quantisation); the signs
are a binary code. Several rotations give several codes, and each code is cut into substrings,
a hash table for each: near vectors share at least one substring with the wanted recall, which
is worked out from the flip rate of codes at the least cosine. Vectors of one bucket are
compared by their original components in double precision.

Each length of vectors has codes of its own. Where a length has few vectors, or no codes reach the
recall, all its vectors of a label are one bucket.

Equal vectors are one class with a count. A pair that meets in several buckets counts in the
first table where it meets. A large bucket is cut into tiles and each two of them are
compared in a task of their own; pairs are only counted and joined, never written out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.graph import components, forest, kept

#: Classes that the rotations are learnt from at most, the same ones at every run.
FIT_ROWS = 10_000
#: Bits of a code at most.
CODE_BITS = 64
#: Vectors of a length up to which there is nothing to learn codes from: all are compared with all.
EXACT = 32
#: Entries of a tile: at least, and at most.
TILE = (256, 4096)
#: Entries that are compared in one call, about, small groups of them together.
PART = 8192


@dataclass
class Codes:
    """Centre and projections of the codes, and the bits of each table: (rotation, first bit, bits)."""

    centre: np.ndarray
    projections: list[np.ndarray]
    tables: list[tuple[int, int, int]]

    def keys(self, x: np.ndarray) -> np.ndarray:
        """For unit vectors the substrings as whole numbers, a column for each table."""
        signs = [(x - self.centre) @ p > 0 for p in self.projections]
        out = np.empty((len(x), len(self.tables)), dtype=np.int64)
        for t, (r, first, bits) in enumerate(self.tables):
            out[:, t] = signs[r][:, first : first + bits] @ (np.int64(1) << np.arange(bits, dtype=np.int64))
        return out


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def rotation(v: np.ndarray, draw: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """The orthogonal matrix that iterative quantisation comes to from a random one."""
    r, _ = np.linalg.qr(draw.standard_normal((v.shape[1], v.shape[1])))
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.sign(v @ r + 1e-30).T @ v)
        r = (left @ right).T
    return r


def learn(x: np.ndarray, near: float, recall: float, key_bits: int, seed: int = 1, most: int = 64) -> Codes | None:
    """Codes for data like the sample ``x`` of vectors: as many tables as ``recall`` takes at the cosine ``near``.

    Recall is measured on pairs made from the sample: half of them have that cosine, the others are
    nearer. Where vectors lie closely around the centre, no codes that are balanced about it find
    them; if ``most`` rotations don't reach the recall, the origin takes the centre's place. None if that
    doesn't reach it either.
    """
    x = unit(x.astype(np.float64))
    for centre in (x.mean(axis=0), np.zeros(x.shape[1])):
        draw = np.random.default_rng(seed)
        _, axes = np.linalg.eigh((x - centre).T @ (x - centre))
        wide = min(CODE_BITS, x.shape[1])
        axes = axes[:, ::-1][:, :wide]
        pairs = np.tile(x, (-(-2000 // len(x)), 1))
        step = draw.standard_normal(pairs.shape)
        step = unit(step - (step * pairs).sum(axis=1, keepdims=True) * pairs)
        angle = math.acos(near) * np.where(draw.random(len(pairs)) < 0.5, 1.0, 10.0 ** draw.uniform(-2, 0, len(pairs)))
        moved = (np.cos(angle)[:, None] * pairs + np.sin(angle)[:, None] * step - centre) @ axes
        still = (pairs - centre) @ axes
        bits = max(1, min(key_bits, wide))
        projections, tables, missed = [], [], np.ones(len(pairs), dtype=bool)
        while missed.mean() > 1 - recall and len(projections) < most:
            r = rotation((x - centre) @ axes, draw)[:, draw.permutation(wide)]  # substrings of any axes
            projections.append(axes @ r)
            same = (still @ r > 0) == (moved @ r > 0)
            for k in range(wide // bits):
                tables.append((len(projections) - 1, k * bits, bits))
                missed &= ~same[:, k * bits : (k + 1) * bits].all(axis=1)
                if missed.mean() <= 1 - recall:
                    break
        if missed.mean() <= 1 - recall:
            return Codes(centre, projections, tables)
    return None


def _keyed(codes: dict[int, Codes]):
    """Keys by the codes of a vector's length; a length without codes has one table with one key."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for length, part in frame.groupby("length", sort=False):
                keys = np.zeros((len(part), 1), dtype=np.int64)
                if length in codes:
                    keys = codes[length].keys(unit(np.stack(part["vector"].to_numpy()).astype(np.float64)))
                yield part.assign(keys=list(keys))

    return run


_GROUP = ["label", "length", "table", "key", "left", "right"]


def _compared(near: float):
    """Links between the entries of two tiles (or within one), as counts and a forest, for many pairs of tiles."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.stack(frame["vector"].to_numpy()).astype(np.float64))
        node, times, keys = frame["node"].to_numpy(), frame["times"].to_numpy(), np.stack(frame["keys"].to_numpy())
        own, table = frame["own"].to_numpy(), frame["table"].to_numpy()
        left, right = frame["left"].to_numpy(), frame["right"].to_numpy()
        found = [(np.zeros(0, np.int64),) * 2]
        count = np.zeros(len(node), dtype=np.int64)
        for at in frame.groupby(_GROUP, sort=False).indices.values():
            rows, columns = at[own[at] == left[at[0]]], at[own[at] == right[at[0]]]
            if not len(rows) or not len(columns):
                continue
            links = x[rows] @ x[columns].T >= near
            links &= node[rows][:, None] != node[columns][None, :]
            if not links.any():
                continue
            for t in range(table[at[0]]):  # counted where they met first
                links &= keys[rows, t][:, None] != keys[columns, t][None, :]
            count[rows] += links @ times[columns]
            if left[at[0]] != right[at[0]]:
                count[columns] += links.T @ times[rows]
            i, j = np.nonzero(links)
            if len(i):
                found.append(forest(node[rows[i]], node[columns[j]]))
        a, b = (np.concatenate([f[i] for f in found]) for i in range(2))
        some = count > 0
        return pd.DataFrame({
            "a": np.concatenate([a, node[some]]),
            "b": np.concatenate([b, node[some]]),
            "n": np.concatenate([np.zeros(len(a), np.int64), count[some]]),
        })

    return run


def embedding_classes(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    near: float = 0.98,
    recall: float = 0.99,
    tile: tuple[int, int] = TILE,
    fit_rows: int = FIT_ROWS,
    exact: int = EXACT,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Two vectors are linked when their labels are equal and not null and their cosine is at
    least ``near``, which takes equal lengths. Vectors that are null, empty or zero, or have null or
    non-finite components, link with nothing. All pairs are compared among up to ``exact`` different vectors
    of a length. Rows with one id count each; a null id counts, but names no component of others.
    An empty table gives none.
    """
    values = F.col("vector")
    usable = (
        (F.size(values) > 0)
        & F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(values, lambda v: v != 0)
        & F.col("label").isNotNull()
    )
    rows = vectors.select(
        F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("string").alias("label")
    ).withColumn("node", F.when(usable, F.xxhash64("label", "vector")))
    named = kept(rows.select("id", "node"), "vectors")
    classes = kept(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.any_value("label").alias("label"),
            F.any_value("vector").alias("vector"),
            F.min("id").alias("first"),
            F.count("*").alias("times"),
        )
        .withColumn("length", F.size("vector")),
        "classes",
    )
    lengths = classes.groupBy("length").agg(F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels"))
    lengths = kept(lengths.where("n > 1"), "lengths")
    links = None
    if lengths.take(1):
        same = classes.join(lengths.select("length"), "length")
        codes = {}
        for length, n, labels in sorted(lengths.where(F.col("n") > exact).collect()):
            sample = classes.where(F.col("length") == length).select("vector", "node")
            sample = sample.orderBy(F.xxhash64("node"), "node").limit(fit_rows).collect()
            bits = max(4, min(40, round(math.log2(max(2, n / max(1, labels)))) + 3))
            learnt = learn(np.array([r[0] for r in sample]), near, recall, bits)
            if learnt is not None:
                codes[length] = learnt
        keyed = kept(
            same.select("node", "label", "length", "times", "vector").mapInPandas(
                _keyed(codes), "node long, label string, length int, times long, vector array<double>, keys array<long>"
            ),
            "codes",
        )
        entries = keyed.select("node", "label", "length", F.posexplode("keys").alias("table", "key"))
        buckets = kept(
            entries.groupBy("label", "length", "table", "key").agg(F.count("*").alias("size")).where("size > 1"), "buckets"
        )
        in_tile = F.greatest(F.lit(tile[0]), F.least(F.lit(tile[1]), F.ceil(F.col("size") / 16)))
        placed = (
            entries.join(buckets, ["label", "length", "table", "key"])
            .withColumn("tiles", F.ceil(F.col("size") / in_tile).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("node", "table"), F.col("tiles")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        )
        pairs = placed.join(keyed.select("node", "times", "vector", "keys"), "node").select(
            "label",
            "length",
            "table",
            "key",
            F.least("own", "other").alias("left"),
            F.greatest("own", "other").alias("right"),
            "own",
            "node",
            "times",
            "vector",
            "keys",
        )
        # small groups share a task; a group has two tiles at most
        entries_in_all = buckets.agg(F.sum(F.col("size") * F.ceil(F.col("size") / in_tile))).first()[0] or 0
        part = F.pmod(F.xxhash64(*_GROUP), F.lit(int(entries_in_all // PART) + 1))
        links = kept(
            pairs.withColumn("part", part).groupBy("length", "part").applyInPandas(_compared(near), "a long, b long, n long"), "links"
        )
    if links is None:
        joined = classes.select("node", F.col("first").alias("component_id"), (F.col("times") - 1).alias("n_links"))
    else:
        counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
        found = kept(components(links.select("a", "b")), "components")
        least = kept(
            found.join(classes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("least")),
            "least",
        )
        joined = (
            classes.select("node", "first", "times")
            .join(counts, "node", "left")
            .join(found.join(least, "component").select("node", "least"), "node", "left")
            .select(
                "node",
                F.coalesce("least", "first").alias("component_id"),
                (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            )
        )
    component = F.coalesce("component_id", "id")
    return named.join(kept(joined, "joined"), "node", "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
