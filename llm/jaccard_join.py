"""N-gram Jaccard join: all links between documents whose shingle sets are near, by metric regions.

A document is the set of its distinct runs of ``width`` lower-cased words; two documents are
linked when 1 - Jaccard, a metric, is at most ``radius``. Equal sets are one point.

Almost all distances are exactly 1, where pivots tell nothing apart. So the space is first cut
where the distance is surely beyond the radius: a run that only one point has cannot be in an
intersection, and a point with too few shared runs has no link at all. Of the others each
joins the regions of its rarest shared runs, as many as make it impossible to be near a point
of no common region. Regions that touch are one. A region too large for a task is split by
pivots: each point goes to the cell of its nearest pivot and, as a boundary point, to every
cell whose pivot is at most twice the radius further away, so that by the triangle inequality
each near pair meets in some cell. Cells are split again in the same way; what pivots no
longer make smaller gets a cell for each rarest run, and tiles if one run's points are too many.
A task does the same with the pivots of each of its regions, down to cells of a few points, and
compares only points that near pivots have not put into one component. Every step loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words
from llm.common import SAMPLE, SHARE, common_values, member
from llm.graph import LINKS, as_struct, components, dealt, forest, kept, packed, text_bytes, unpacked

#: Runs that one task holds at a time.
BUCKET_RUNS = 1_000_000
#: Shared runs of the points of a region that one task joins by itself.
REGION_RUNS = 1_000_000
#: Up to so many documents that go are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
#: Pivots of a region that is split.
PIVOTS = 32
#: Points of a cell that are compared without further pivots.
LEAF = 4
#: Numbers in the matrices of a comparison at a time.
BLOCK = 4_000_000


def _least(size: np.ndarray, near: tuple[int, int]) -> np.ndarray:
    """Of a set's runs, how many must be in another set that is near."""
    return -(-near[0] * size // near[1])


def _node(runs: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set of runs."""
    sums = np.zeros(len(runs) + 1, dtype=np.uint64)
    np.cumsum(words.mixed(runs), out=sums[1:])
    name = sums[offsets[1:]] - sums[offsets[:-1]]
    return words.mixed(name ^ (np.diff(offsets).astype(np.uint64) << np.uint64(40))).view(np.int64)


def _points(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, node = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, some in words.chunks(batch.column(1), lower=True):
                runs, offsets = words.shingle_sets(some, width)
                size.append(np.diff(offsets))
                node.append(_node(runs, offsets))
            size, node = np.concatenate(size), np.concatenate(node)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size), pa.array(node, mask=size == 0)], ["id", "whole", "n_shingles", "node"]
            )

    return run


def _set_runs(width: int):
    def run(some: words.Words) -> tuple[np.ndarray, np.ndarray]:
        runs, offsets = words.shingle_sets(some, width)
        return runs, np.repeat(np.arange(len(some)), np.diff(offsets))

    return run


def _dealt_runs(width: int, buckets: int, common: np.ndarray, most: int = 1_000_000):
    """Rows of a bucket of runs: the runs, the points that have them, and how many each has; about ``most`` runs at a time.

    Common runs, known to be shared, go straight to their points' buckets, numbered after those of the runs.
    """

    def deal(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        size = np.concatenate([x[1] for x in parts])
        node = np.concatenate([x[2] for x in parts])
        runs, owner = np.concatenate([x[0] for x in parts]), np.repeat(np.arange(len(node), dtype=np.int32), size)
        own = (node.view(np.uint64) % np.uint64(buckets))[owner] + np.uint64(buckets)
        bucket = np.where(member(runs, common), own, (runs >> np.uint64(20)) % np.uint64(buckets))
        order, bounds = dealt(bucket, 2 * buckets)
        runs, owner = runs[order], owner[order]
        rows: tuple[list, list, list, list] = ([], [], [], [])
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            lo, hi = bounds[k], bounds[k + 1]
            new = np.ones(hi - lo, dtype=bool)  # the order is stable: a point's runs are side by side
            new[1:] = owner[lo + 1 : hi] != owner[lo : hi - 1]
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, hi - lo)).astype(np.int32)
            for x, y in zip(rows, (k, packed(runs[lo:hi]), packed(node[owner[lo:hi][first]]), packed(count)), strict=True):
                x.append(y)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int32()), *(pa.array(x, pa.binary()) for x in rows[1:])],
            ["bucket", "runs", "nodes", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            for _, _, some in words.chunks(batch.column(0), lower=True):
                runs, offsets = words.shingle_sets(some, width)
                node, size = _node(runs, offsets), np.diff(offsets)
                new = np.zeros(len(node), dtype=bool)  # equal sets of a task are sent once
                for i, x in enumerate(node.tolist()):
                    if size[i] and x not in seen:
                        new[i] = True
                        if len(seen) < 1_000_000:
                            seen.add(x)
                runs = runs[np.repeat(new, size)]
                parts.append((runs, size[new], node[new]))
                held += len(runs)
                if held >= most:
                    yield deal(parts)
                    parts, held = [], 0
        if held:
            yield deal(parts)

    return run


def _shared(doc_buckets: int):
    """Of a bucket of runs, those that several points have, dealt out again by point; a run comes with its count.

    Common runs are with their points already; they count as the most frequent ones everywhere.
    """

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        if key[0] >= doc_buckets:
            runs = unpacked(frame["runs"], np.uint64)
            node = np.repeat(unpacked(frame["nodes"], np.int64), unpacked(frame["counts"], np.int32))
            order = np.lexsort((runs, node))
            runs, node = runs[order], node[order]
            new = np.ones(len(runs), dtype=bool)
            new[1:] = (runs[1:] != runs[:-1]) | (node[1:] != node[:-1])
            count = np.full(int(new.sum()), 2**31 - 1, dtype=np.int32)
            row = (key[0] - doc_buckets, packed(runs[new]), packed(node[new]), packed(count))
            return pd.DataFrame([row], columns=["bucket", "runs", "nodes", "counts"])
        runs = unpacked(frame["runs"], np.uint64)
        node = np.repeat(unpacked(frame["nodes"], np.int64), unpacked(frame["counts"], np.int32))
        order = np.argsort(runs, kind="stable")
        runs, node = runs[order], node[order]
        twice = np.zeros(len(runs), dtype=bool)
        same = runs[1:] == runs[:-1]
        twice[1:] |= same
        twice[:-1] |= same
        runs, node = runs[twice], node[twice]
        order = np.lexsort((node, runs))  # equal sets from different tasks count once
        runs, node = runs[order], node[order]
        new = np.ones(len(runs), dtype=bool)
        new[1:] = (runs[1:] != runs[:-1]) | (node[1:] != node[:-1])
        runs, node = runs[new], node[new]
        first = np.ones(len(runs), dtype=bool)
        first[1:] = runs[1:] != runs[:-1]
        group = np.cumsum(first) - 1
        count = np.bincount(group)[group] if len(group) else group
        several = count > 1
        runs, node, count = runs[several], node[several], count[several]
        order, bounds = dealt(node.view(np.uint64), doc_buckets)
        rows = []
        for k in range(doc_buckets):
            at = order[bounds[k] : bounds[k + 1]]
            if len(at):
                at = at[np.argsort(node[at], kind="stable")]
                rows.append((k, packed(runs[at]), packed(node[at]), packed(np.minimum(count[at], 2**31 - 2).astype(np.int32))))
        return pd.DataFrame(rows, columns=["bucket", "runs", "nodes", "counts"])

    return run


def _regions(near: tuple[int, int], run_buckets: int):
    """Of a bucket of points: those that may have a link, with their shared runs, and their regions.

    kind 0: a point (node, size, its shared runs, the rarest first); kind 1: a link between two points of this bucket with
    a common region; kind 2: regions, a point for each, dealt out by region.
    """

    def run(key: tuple, shared: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        runs, node, count = (
            unpacked(shared[c], t) for c, t in (("runs", np.uint64), ("nodes", np.int64), ("counts", np.int32))
        )
        rows: list[tuple] = []
        order = np.lexsort((runs, count, node))  # by point, the rarest runs first
        runs, node = runs[order], node[order]
        own, begin = np.unique(node, return_index=True)
        stop = np.append(begin[1:], len(node))
        sizes = points.drop_duplicates("node").set_index("node")["n_shingles"]
        size = sizes.reindex(own).to_numpy().astype(np.int64)
        spare = (stop - begin) - _least(size, near)
        region, member = [], []
        for i in np.flatnonzero(spare >= 0):
            mine = runs[begin[i] : stop[i]]
            rows.append((0, 0, int(own[i]), int(size[i]), packed(mine), b""))
            region.append(mine[: spare[i] + 1])
            member.append(np.full(spare[i] + 1, own[i]))
        if region:
            region, member = np.concatenate(region), np.concatenate(member)
            order = np.lexsort((member, region))
            region, member = region[order], member[order]
            first = np.ones(len(region), dtype=bool)
            first[1:] = region[1:] != region[:-1]
            chief = member[first][np.cumsum(first) - 1]
            a, b = forest(member[~first], chief[~first]) if (~first).any() else (member[:0], member[:0])
            rows.append((1, 0, 0, 0, packed(a), packed(b)))
            region, member = region[first], member[first]
            order, bounds = dealt(region >> np.uint64(20), run_buckets)
            for k in range(run_buckets):
                at = order[bounds[k] : bounds[k + 1]]
                if len(at):
                    rows.append((2, k, 0, 0, packed(region[at]), packed(member[at])))
        return pd.DataFrame(rows, columns=["kind", "bucket", "node", "n_shingles", "x", "y"])

    return run


def _touching(frame: pd.DataFrame) -> pd.DataFrame:
    """Links between the points of one region, as a star, over a bucket of regions."""
    region, member = unpacked(frame["x"], np.uint64), unpacked(frame["y"], np.int64)
    order = np.lexsort((member, region))
    region, member = region[order], member[order]
    first = np.ones(len(region), dtype=bool)
    first[1:] = region[1:] != region[:-1]
    chief = member[first][np.cumsum(first) - 1] if len(region) else member
    a, b = forest(member[~first], chief[~first])
    return pd.DataFrame({"a": a, "b": b})


def _unpack_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"a": unpacked(frame["x"], np.int64), "b": unpacked(frame["y"], np.int64)})


def _common(runs: list[np.ndarray], rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(some of ``rows``, how many runs these points have in common with each point)."""
    names, at = np.unique(np.concatenate(runs), return_inverse=True)
    owner = np.repeat(np.arange(len(runs)), [len(x) for x in runs])
    count = np.bincount(at, minlength=len(names))
    column = np.cumsum(count > 1) - 1
    useful = count[at] > 1
    at, owner = column[at[useful]], owner[useful]
    width, each = int((count > 1).sum()), BLOCK // len(runs)
    tall, broad = max(1, min(1024, each)), max(1, min(2048, each))
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for low in range(0, len(rows), tall):
        mine = rows[low : low + tall]
        found = np.zeros((len(mine), len(runs)), dtype=np.float32)
        for left in range(0, width, broad):
            lo, hi = np.searchsorted(at, [left, left + broad])
            some = np.zeros((len(runs), min(broad, width - left)), dtype=np.float32)
            some[owner[lo:hi], at[lo:hi] - left] = 1
            found += some[mine] @ some.T
        yield mine, found


class _Region:
    """The points of a region and, as they become known, their components: ``label`` is a point of each."""

    def __init__(self, size: np.ndarray, runs: list[np.ndarray], near: tuple[int, int]) -> None:
        self.size, self.runs, self.near = size, runs, near
        self.label = np.arange(len(size))
        names, at = np.unique(np.concatenate(runs), return_inverse=True)
        self.at = np.split(at, np.cumsum([len(x) for x in runs])[:-1])
        self.marked = np.zeros(len(names), dtype=bool)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = forest(self.label[a], self.label[b])
        root = {x: x for x in np.union1d(a, b).tolist()}

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            root[top(x)] = top(y)
        if root:
            into = np.arange(len(self.label))
            into[list(root)] = [top(x) for x in root]
            self.label = into[self.label]

    def common(self, pivot: int, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        self.marked[self.at[pivot]] = True
        sums = np.concatenate([[0], np.cumsum(self.marked[at])])
        self.marked[self.at[pivot]] = False
        return sums[starts[1:]] - sums[starts[:-1]]

    def cells(self, points: np.ndarray, pivots: int) -> list[np.ndarray]:
        """The cells of pivots that are far from one another, boundary points in several; points near a pivot are joined."""
        at = np.concatenate([self.at[i] for i in points])
        starts = np.concatenate([[0], np.cumsum([len(self.at[i]) for i in points])])
        radius, far, least, pivot = 1 - self.near[0] / self.near[1], [], np.full(len(points), 2.0), 0
        while len(far) < pivots and least[pivot] > radius:
            common = self.common(points[pivot], at, starts)
            union = self.size[points] + self.size[points[pivot]] - common
            linked = points[common * self.near[1] >= union * self.near[0]]
            self.join(linked, np.full(len(linked), points[pivot]))
            far.append(1 - common / union)
            least = np.minimum(least, far[-1])
            pivot = int(np.argmax(least))
        return [points[x <= least + 2 * radius + 1e-9] for x in far]

    def compare(self, points: np.ndarray) -> int:
        """Every two points of different components, but for two of the largest: they are one already."""
        label, count = np.unique(self.label[points], return_counts=True)
        rest = np.flatnonzero(self.label[points] != label[np.argmax(count)])
        for mine, common in _common([self.runs[i] for i in points], rest):
            common = common.astype(np.int64)
            union = self.size[points[mine], None] + self.size[points][None, :] - common
            i, j = np.nonzero(common * self.near[1] >= union * self.near[0])
            self.join(points[mine[i]], points[j])
        return len(rest) * len(points)


def near_links(node: np.ndarray, size: np.ndarray, runs: list[np.ndarray], near: tuple[int, int], tally: dict | None = None):
    """Links between points of one region as a forest: exact, by pivots, cells and windows.

    Cells are split again until they are small, have one component or no longer become smaller; then
    the sizes of intersections are compared. ``tally`` counts splits and comparisons.
    """
    if len(node) < 2:
        return node[:0], node[:0]
    region, tally = _Region(size, runs, near), {} if tally is None else tally
    waiting = [np.arange(len(node))]
    while waiting:
        points = waiting.pop()
        if len(points) > LEAF:
            cells = region.cells(points, max(2, min(max(PIVOTS, len(points) // 8), BLOCK // len(points))))
            tally["splits"] = tally.get("splits", 0) + 1
            cells = [x for x in cells if (region.label[x] != region.label[x[0]]).any()]
            if sum(len(x) for x in cells) <= 2 * len(points) and all(len(x) <= 0.7 * len(points) for x in cells):
                waiting += cells
                continue
        if (region.label[points] != region.label[points[0]]).any():
            tally["compared"] = tally.get("compared", 0) + region.compare(points)
    linked = np.flatnonzero(region.label != np.arange(len(node)))
    return node[linked], node[region.label[linked]]


def _solve(near: tuple[int, int]):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64),) * 2]
        for _, some in frame.groupby("region", sort=False):
            some = some.drop_duplicates("node")
            found.append(
                near_links(
                    some["node"].to_numpy(),
                    some["n_shingles"].to_numpy(),
                    [np.frombuffer(x, np.uint64) for x in some["runs"]],
                    near,
                )
            )
        return pd.DataFrame({c: np.concatenate([x[i] for x in found]) for i, c in enumerate("ab")})

    return run


_MEMBER = "region string, node long, n_shingles long, runs binary"


def _cells(near: tuple[int, int]):
    """Some points of a region and all its pivots: the cells in which each point belongs."""

    def run(key: tuple, points: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(points):
            return points[["region", "node", "n_shingles", "runs"]]
        centre = [np.frombuffer(x, np.uint64) for x in pivots["runs"]]
        wide = pivots["n_shingles"].to_numpy()
        out = []
        for row in points.itertuples():
            mine = np.frombuffer(row.runs, np.uint64)
            common = np.array([np.isin(mine, x, assume_unique=True).sum() for x in centre])
            far = 1 - common / (row.n_shingles + wide - common)
            window = far.min() + 2 * (1 - near[0] / near[1]) + 1e-9
            for k in np.flatnonzero(far <= window):
                out.append((f"{row.region}/{pivots['node'].iat[k]}", row.node, row.n_shingles, row.runs))
        return pd.DataFrame(out, columns=["region", "node", "n_shingles", "runs"])

    return run


def _joined_regions(members: DataFrame, near: tuple[int, int], most: int, pivots: int) -> DataFrame:
    """Links within the regions, regions beyond ``most`` shared runs being split by pivots again and again."""
    runs = F.octet_length("runs") / 8
    links, before = None, None
    while True:
        weights = kept(members.groupBy("region").agg(F.sum(runs).alias("weight"), F.count("*").alias("n")), "weights")
        total, largest = weights.agg(F.sum("weight"), F.max("weight")).first()
        buckets = max(1, int((total or 0) / most) + 1)
        small = members.join(weights.where(F.col("weight") <= most), "region")
        part = (
            small.withColumn("part", F.pmod(F.xxhash64("region"), F.lit(buckets)))
            .groupBy("part")
            .applyInPandas(_solve(near), LINKS)
        )
        links = part if links is None else links.unionByName(part)
        if (largest or 0) <= most:
            return links
        large = kept(members.join(weights.where(F.col("weight") > most), "region"), "large")
        if before is not None and largest > 0.7 * before:
            return links.unionByName(_by_rarest(large, near, most))
        before, volume = largest, large.agg(F.sum(runs)).first()[0]
        draw = F.pmod(F.xxhash64("node", F.lit(int(largest))), F.lit(1_000_000)) / 1_000_000
        chosen = large.where(draw < F.lit(float(pivots)) / F.col("n"))
        salts = int(largest / most) + 1
        spread = F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        points = large.withColumn("salt", spread).groupBy("region", "salt")
        centres = chosen.withColumn("salt", copies).groupBy("region", "salt")
        members = kept(points.cogroup(centres).applyInPandas(_with_home(near), _MEMBER), "cells")
        if members.agg(F.sum(runs)).first()[0] > 4 * volume:  # everything is near the boundary of everything
            return links.unionByName(_by_rarest(large, near, most))


def _with_home(near: tuple[int, int]):
    cells = _cells(near)

    def run(key: tuple, points: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(pivots):  # no pivot was drawn: the region stays as it is
            return points[["region", "node", "n_shingles", "runs"]]
        return cells(key, points, pivots)

    return run


def _rarest(near: tuple[int, int]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            runs = [np.frombuffer(x, np.int64) for x in frame["runs"]]
            spare = np.array([len(x) for x in runs], dtype=np.int64) - _least(frame["n_shingles"].to_numpy(), near) + 1
            some = [x[:n] for x, n in zip(runs, spare.tolist(), strict=True)]
            at = np.repeat(np.arange(len(frame)), [len(x) for x in some])
            yield pd.DataFrame(
                {
                    "region": frame["region"].to_numpy()[at],
                    "node": frame["node"].to_numpy()[at],
                    "run": np.concatenate([*some, np.zeros(0, np.int64)]),
                }
            )

    return run


def _by_rarest(large: DataFrame, near: tuple[int, int], most: int) -> DataFrame:
    """Links within regions that pivots don't split: a cell for each of a point's rarest runs, as near points share one.

    Runs with the same points make one cell. Only points of one such run too many for a task are compared tile by tile.
    """
    own = kept(large.select("region", "node", "n_shingles", "runs").mapInPandas(_rarest(near), "region string, node long, run long"), "rarest")
    names = [F.bit_xor(F.xxhash64("node", F.lit(salt))).alias(f"name{salt}") for salt in (1, 2)]
    shared = own.groupBy("region", "run").agg(F.count("*").alias("n"), *names).where("n > 1")
    one = shared.groupBy("region", "n", "name1", "name2").agg(F.min("run").alias("run")).select("region", "run")
    cell = F.concat_ws("#", "region", F.hex("run")).alias("region")
    cells = own.join(one, ["region", "run"]).join(large, ["region", "node"]).select(cell, "node", "n_shingles", "runs")
    cells = kept(cells, "cells-by-run")
    weights = kept(cells.groupBy("region").agg(F.sum(F.octet_length("runs") / 8).alias("weight")), "weights")
    total = weights.agg(F.sum("weight")).first()[0]
    part = F.pmod(F.xxhash64("region"), F.lit(int((total or 0) / most) + 1)).alias("part")
    small = cells.join(weights.where(F.col("weight") <= most), "region").select(part, "region", "node", "n_shingles", "runs")
    found = small.groupBy("part").applyInPandas(_solve(near), LINKS)
    return found.unionByName(_tiled(cells.join(weights.where(F.col("weight") > most), "region"), near, most))


def _tiled(large: DataFrame, near: tuple[int, int], most: int) -> DataFrame:
    """Links within large regions by comparing every tile of points with every other, a task for each two."""
    tiles = F.ceil(2 * F.col("weight") / most).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("tiles")).cast("int")
    pairs = (
        large.withColumn("tiles", tiles)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            F.concat_ws("|", "region", F.least("own", "other"), F.greatest("own", "other")).alias("region"),
            "node",
            "n_shingles",
            "runs",
        )
    )
    return pairs.groupBy("region").applyInPandas(_solve(near), LINKS)


def jaccard_points(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """(id, whole, n_shingles, node): a hash of each document's text, the size of its set and the set's name, null for an empty one."""
    slim = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("whole"))
    return slim.mapInArrow(_points(width), f"id {dict(docs.dtypes)[id]}, whole long, n_shingles long, node long")


def _linked(
    docs: DataFrame,
    points: DataFrame,
    id: str,
    text: str,
    width: int = 5,
    near: tuple[int, int] = (75, 100),
    region_runs: int = REGION_RUNS,
    bucket_runs: int = BUCKET_RUNS,
    pivots: int = PIVOTS,
    common_share: float = SHARE,
    common_sample: int = SAMPLE,
) -> DataFrame:
    """(node, component) of the points that have links."""
    expected = text_bytes(docs, text) // 6
    buckets = max(8, expected // bucket_runs + 1)
    blocks = "bucket int, runs binary, nodes binary, counts binary"
    common = common_values(docs, id, text, _set_runs(width), True, common_share, common_sample)
    runs = docs.select(F.col(text).alias("text")).mapInArrow(_dealt_runs(width, buckets, common), blocks)
    shared = runs.groupBy("bucket").applyInPandas(_shared(buckets), blocks)
    nodes = points.where("node IS NOT NULL").select("node", "n_shingles").distinct()
    # the remainder of the name as an unsigned number, as in dealt()
    bucket = F.pmod(F.pmod("node", F.lit(buckets)) + F.when(F.col("node") < 0, (2**64) % buckets).otherwise(0), F.lit(buckets))
    nodes = nodes.withColumn("bucket", bucket.cast("int"))
    found = kept(
        shared.groupBy("bucket")
        .cogroup(nodes.groupBy("bucket"))
        .applyInPandas(_regions(near, buckets), "kind int, bucket int, node long, n_shingles long, x binary, y binary"),
        "regions",
    )
    touching = (
        found.where("kind = 2").select("bucket", "x", "y").groupBy("bucket").applyInPandas(_touching, LINKS)
    ).unionByName(found.where("kind = 1").select("x", "y").mapInPandas(_unpack_links, LINKS))
    regions = kept(components(touching), "touching")
    members = kept(
        found.where("kind = 0")
        .select("node", "n_shingles", F.col("x").alias("runs"))
        .join(regions, "node")
        .select(F.col("component").cast("string").alias("region"), "node", "n_shingles", "runs"),
        "members",
    )
    return kept(components(_joined_regions(members, near, region_runs, pivots)), "linked")

def jaccard_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, **options) -> DataFrame:
    """One row (id, n_shingles, component_id) per document, links as described in the module.

    ``component_id`` is the smallest id that links reach. A document without words, empty or
    null, has no set and is its own component. Rows with equal ids are one node as far as
    their sets are equal; rows with a null id count as documents but never name a component
    of others. Further columns of ``docs`` don't matter; an empty table gives none. ``options`` are those of
    the join: ``near`` (the least Jaccard similarity as a fraction), and bounds for a task's work.
    """
    points = kept(jaccard_points(docs, id, text, width), "points")
    linked = _linked(docs, points, id, text, width, **options)
    first = kept(points.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("first")), "first")
    named = kept(first.join(linked, "node"), "named")
    least = kept(named.groupBy("component").agg(F.min("first").alias("least")), "least")
    of_node = kept(
        first.join(named.join(least, "component").select("node", "least"), "node", "left").select(
            "node", F.coalesce("least", "first").alias("component_id")
        ),
        "of-node",
    )
    return points.join(of_node, "node", "left").select(
        "id", "n_shingles", F.coalesce("component_id", "id").alias("component_id")
    )


def one_per_component(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, **options) -> DataFrame:
    """One document of each component, all columns unchanged: that of the smallest id, then of the smallest set name.

    Rows that repeat the chosen document stay once, any one of them. A row without an id stays only if no other in its
    component has one. Documents without words are linked with nothing, so all stay. Documents are known by id and
    text, so two texts of one id are two documents.
    """
    points = kept(jaccard_points(docs, id, text, width), "points")
    linked = _linked(docs, points, id, text, width, **options)
    own = points.where("node IS NOT NULL").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "node", "whole")
    best = own.groupBy("component").agg(F.min(order).alias("best"), F.count("*").alias("n")).where("n > 1")
    best = kept(best.select("component", F.col("best.id").alias("best_id"), F.col("best.whole").alias("best_whole")), "best")
    chosen = F.col("id").eqNullSafe(F.col("best_id")) & (F.col("whole") == F.col("best_whole"))
    keys = own.join(best, "component").groupBy("id", "whole").agg(F.bool_or(chosen).alias("chosen"), F.count("*").alias("n"))
    # most documents are alone: what has to go, and what is there several times, is the smaller side
    keys = kept(keys.where("NOT chosen OR n > 1").select(F.col("id").alias("_id"), F.col("whole").alias("_whole"), "chosen"), "keys")
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys.hint("merge")
    same = F.col("_id").eqNullSafe(F.col(f"doc.{id}")) & (F.col("_whole") == F.xxhash64(f"doc.{text}"))
    rows = as_struct(docs, "doc").join(keys, same, "left").where("chosen IS NULL OR chosen")
    several = kept(rows.where("chosen").select("doc", "_id", "_whole"), "several").dropDuplicates(["_id", "_whole"])
    return rows.where("chosen IS NULL").select("doc.*").unionByName(several.select("doc.*"))
