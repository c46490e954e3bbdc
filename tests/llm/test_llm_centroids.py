"""Clustering with Ptolemaic bounds against plain rounds over all centroids."""

import hashlib

import numpy as np
import pytest

from llm.centroids import LARGEST, Nearest, clustered, spread, squared


def brute(rows, clusters, rounds, width):
    """Plain exact rounds in Python integers."""
    kept = [(i, [int(np.floor(x * 1024)) for x in v]) for i, v in rows if v is not None and len(v) == width and all(
        x is not None and np.isfinite(x) for x in v)]
    named = sorted(kept, key=lambda r: ((r[0] is None), hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in named[:clusters]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(assign(v)[1], []).append(v)
        centroids = [
            [sum(col) // len(members[k]) for col in zip(*members[k], strict=True)] if k in members else c for k, c in enumerate(centroids)
        ]
    found = [(i, *reversed(assign(v))) for i, v in kept]
    inertia = [sum(d for _, k, d in found if k == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia), digest[k]) for i, k, d in found), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, id string, v int")


@pytest.mark.parametrize("shift", [0.0, 50.0])
def test_against_plain_rounds(spark, shift):
    draw = np.random.default_rng(5)
    middle = draw.normal(size=(6, 64)) * 3
    rows = [(i, [float(np.float32(x)) for x in middle[i % 6] + draw.normal(size=64) * 0.3 + shift]) for i in range(400)]
    found = sorted((tuple(r) for r in clustered(frame(spark, rows)).collect()), key=repr)
    assert found == brute(rows, 8, 10, 64)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [5.0, 2.5]), (3, None), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [nan, 1.0]),
        (8, [inf, 1.0]), (None, [0.0, 0.0]), (None, None), (9, [-0.0004, -7.5]), (10, [0.0, 0.0]), (11, [3.0, 2.25]), (12, [-1.0, 2.0]),
    ]
    for clusters in (1, 3, 8, 20):
        found = clustered(frame(spark, rows), clusters=clusters, components=2)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows, clusters, 10, 2)
    assert found.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_without_vectors(spark):
    empty = clustered(frame(spark, [(1, None)]))
    assert empty.count() == 0 and empty.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_large_components(spark):
    with pytest.raises(ValueError, match="below"):
        clustered(frame(spark, [(1, [1.0] * 63 + [float(LARGEST)])]))


def test_bounds_never_exceed_and_save_work():
    draw = np.random.default_rng(7)
    middle = draw.integers(-3000, 3000, (8, 64))
    x = middle[draw.integers(0, 8, 5000)] + draw.integers(-200, 200, (5000, 64))
    pivots = spread(x[:64], 5)
    cached = np.stack([squared(x, p) for p in pivots], axis=1)
    nearest = Nearest(middle, pivots)
    exact = np.stack([squared(x, c) for c in middle], axis=1)
    assert (nearest.bounds(cached) <= exact).all()
    cluster, best, measured = nearest(x, cached)
    assert (best == exact.min(axis=1)).all() and (cluster == exact.argmin(axis=1)).all()
    assert measured < 0.5 * exact.size


def test_bounds_at_the_largest_components():
    draw = np.random.default_rng(8)
    x = draw.choice(np.array([-LARGEST + 1, LARGEST - 1, 0, 1]), (500, 64))
    pivots = spread(x[:64], 4)
    nearest = Nearest(x[64:72], pivots)
    cached = np.stack([squared(x, p) for p in pivots], axis=1)
    exact = np.stack([squared(x, c) for c in x[64:72]], axis=1)
    assert (exact >= 0).all() and (nearest.bounds(cached) <= exact).all()
    assert (nearest(x, cached)[0] == exact.argmin(axis=1)).all()


def test_one_pivot_only():
    x = np.zeros((4, 3), dtype=np.int64)
    pivots = spread(x, 5)
    assert len(pivots) == 1
    cluster, best, measured = Nearest(np.array([[1, 0, 0], [0, 0, 0]]), pivots)(x, np.zeros((4, 1), dtype=np.int64))
    assert cluster.tolist() == [1] * 4 and best.tolist() == [0] * 4 and measured == 8
