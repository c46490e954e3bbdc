"""The Jaccard join, substring dedup and embeddings against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from llm import words
from llm.common import common_values
from llm.embedding_dedup import embedding_classes, learn
from llm.graph import components
from llm.jaccard_join import _by_rarest, _set_runs, jaccard_classes, near_links, one_per_component
from llm.substring_dedup import _anchors, _stretches, repeated_words, window_anchors, window_hashes

SMALL = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(words.WORD, text or "")


def shingles(text, width=5):
    w = split((text or "").translate(LOW))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def roots(nodes, links):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in nodes}


def brute_classes(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    links = [
        (i, j)
        for (i, a), (j, b) in itertools.combinations(sets, 2)
        if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b)
    ]
    found = roots({i for i, _ in sets if i is not None}, links)
    return {i: (len(s), found[i]) for i, s in sets if i is not None}


def chain(n, seed):
    """Texts that drift from one to the next, so that regions are long and links are near the bound."""
    rng = random.Random(seed)
    text = [f"v{rng.randrange(50)}" for _ in range(60)]
    rows = []
    for k in range(n):
        rows.append((k, " ".join(text)))
        for _ in range(rng.randrange(1, 4)):
            text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
    rng.shuffle(rows)
    return rows


def check_classes(spark, rows, **options):
    got = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    wanted = brute_classes(rows)
    assert len(got) == len(rows)
    assert {(r.id, r.n_shingles, r.component_id) for r in got} == {(i, *wanted[i]) for i, _ in rows}


def test_jaccard_on_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check_classes(spark, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("options", [{}, {"region_runs": 400, "pivots": 6, "bucket_runs": 100}])
def test_jaccard_in_drifting_texts(spark, options):
    check_classes(spark, chain(60, 5) + [(1000 + i, t) for i, t in chain(30, 6)], **options)


def points_of(texts):
    """Points of one region as the join has them: the runs that several have, the rarest first."""
    sets = [words.shingle_sets(next(words.chunks(pa.array([t]), lower=True))[2], 5)[0] for t in texts]
    names, count = np.unique(np.concatenate(sets), return_counts=True)
    often = [count[np.searchsorted(names, x)] for x in sets]
    runs = [x[np.lexsort((x, n))][(n == 1).sum() :] for x, n in zip(sets, often, strict=True)]
    return np.array([len(x) for x in sets]), runs


def check_links(texts, a, b):
    rows = list(enumerate(texts))
    wanted = {i: c for i, (_, c) in brute_classes(rows).items()}
    assert roots(range(len(texts)), zip(a, b, strict=True)) == wanted
    assert len(a) == len(texts) - len(set(wanted.values()))  # a forest


def test_pivots_decide_in_a_region(spark):
    """All given documents as one region, and drifting texts: splits by pivots, links as by brute force."""
    given = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect() if r.text and split(r.text)]
    given = sorted({shingles(t): t for t in given}.values())
    for texts in (given, [t for _, t in chain(200, 7)], [t for k in range(40) for _, t in chain(8, k)]):
        texts = list(dict.fromkeys(texts))
        size, runs = points_of(texts)
        tally = {}
        a, b = near_links(np.arange(len(texts)), size, runs, (75, 100), tally)
        check_links(texts, a.tolist(), b.tolist())
        assert tally["splits"] >= 1


def test_copies_about_a_pivot_are_not_compared_with_each_other():
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[:k], f"x{n}", *base[k:]]) for n in range(400) for k in [rng.randrange(200)]]
    size, runs = points_of(texts)
    tally = {}
    a, b = near_links(np.arange(400), size, runs, (75, 100), tally)
    assert len(a) == 399 and tally.get("compared", 0) == 0


@pytest.mark.parametrize("most", [1_000_000, 800])
def test_a_percolating_region_is_split_by_rarest_runs(spark, most):
    """Texts that pass passages on to the next touch all along, but are near few others."""
    rng = random.Random(3)
    passage = [" ".join(f"p{k}_{i}" for i in range(20)) for k in range(60)]
    texts = [f"{passage[k]} own{k} {passage[(k + 1) % 60]}" for k in range(60)]
    texts += [t + " end" for t in rng.sample(texts, 20)]
    size, runs = points_of(texts)
    rows = [("r", k, int(size[k]), runs[k].tobytes()) for k in range(len(texts)) if 4 * len(runs[k]) >= 3 * size[k]]
    large = spark.createDataFrame(rows, "region string, node long, n_shingles long, runs binary")
    weight = sum(len(r[3]) / 8 for r in rows)
    found = _by_rarest(large.selectExpr("*", f"{weight}D AS weight"), (75, 100), most).collect()
    wanted = {i: c for i, (_, c) in brute_classes(list(enumerate(texts))).items()}
    assert roots(range(len(texts)), [(r.a, r.b) for r in found]) == wanted


def test_common_values_are_bounded_by_entries(spark):
    """A value of few documents by share is common where ``most`` says so; the sample grows with it."""
    rows = [(i, f"a b c d {i % 5} e f g h i{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    some = common_values(df, "doc_id", "text", _set_runs(5), True, share=0.5, sample=40)
    more = common_values(df, "doc_id", "text", _set_runs(5), True, share=0.5, sample=40, most=40)
    assert len(some) < len(more) and set(some.tolist()) <= set(more.tolist())


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)]
    links += [(k, k + 1) for k in range(1000, 1100)] + [(2000, k) for k in range(1900, 2100)] + [(3, 3), (None, 4), (5, None)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    got = {r.node: r.component for r in components(df).collect()}
    assert got == roots({x for link in real for x in link}, real)
    assert components(df.limit(0)).count() == 0


def test_common_runs_are_told_from_a_sample(spark):
    rows = chain(60, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = common_values(df, "doc_id", "text", _set_runs(5), True, share=0.3, sample=50)
    sets = [shingles(t) for _, t in rows]
    assert len(found) == len(set(found.tolist())) > 0
    assert len(found) <= len({s for x in sets for s in x if sum(s in y for y in sets) >= 10})
    assert len(common_values(df, "doc_id", "text", _set_runs(5), True, sample=100)) == 0


def test_jaccard_odd_rows(spark, odd_docs):
    got = sorted((repr(r.id), r.n_shingles, r.component_id) for r in jaccard_classes(odd_docs).collect())
    assert got == sorted(
        [
            ("1", 12, 1), ("2", 12, 1), ("2", 12, 1), ("None", 12, 1), ("3", 12, 3), ("4", 0, 4), ("5", 0, 5), ("6", 0, 6),
            ("None", 0, None), ("8", 2996, 8), ("9", 2997, 8), ("10", 1, 10), ("11", 1, 10),
        ],
        key=repr,
    ) or set(got) == {
        ("1", 12, 1), ("2", 12, 1), ("None", 12, 1), ("3", 12, 3), ("4", 0, 4), ("5", 0, 5), ("6", 0, 6),
        ("None", 0, None), ("8", 2996, 8), ("9", 2997, 8), ("10", 1, 10), ("11", 1, 10),
    }
    assert jaccard_classes(odd_docs.limit(0)).count() == 0


def brute_words(rows, width):
    where = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - width + 1):
            where.setdefault(tuple(w[k : k + width]), set()).add(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in where.items()}
    out = []
    for i, t in rows:
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            first = least[tuple(w[k : k + width])]
            if first is not None and (i is None or first < i):
                gone[k : k + width] = [True] * width
        text = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((repr(i), len(w), sum(gone), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def check_words(spark, rows, width, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((repr(r.id), r.n_words, r.n_removed, r.kept_sha256) for r in repeated_words(df, width=width, **options).collect())
    assert got == brute_words(rows, width)


def test_repeated_words_on_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    check_words(spark, [tuple(r) for r in docs], 50)


def test_repeated_words_with_few_kinds_of_words(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(100, "a " * 500), (101, "a " * 300), (None, "a " * 20), (7, "b " * 30), (7, "b " * 30)]
    check_words(spark, rows, 6, run=3, group_bytes=300)


def test_common_passages_are_not_gathered(spark):
    rng = random.Random(12)
    passage, line = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("p", 30), ("q", 9)))
    own = lambda: " ".join(rng.choice("abcdefghij") + str(rng.randrange(99)) for _ in range(rng.randrange(3, 20)))
    rows = [(i, f"{own()} {rng.choice([passage, line, own()])} {own()} {rng.choice(['', line, passage])}") for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[1][1] + " end"), (None, passage)]
    check_words(spark, rows, 8, group_bytes=1 << 10, common_share=0.1, common_sample=200)
    check_words(spark, rows, 8, run=3, group_bytes=1 << 10, common_share=0.02, common_sample=200)
    texts = pd.DataFrame({"node": range(300), "id": range(300), "text": [f"{own()} {passage} {own()}" for _ in range(300)]})
    some = next(words.chunks(pa.array([passage])))[2]
    none, common = np.zeros(0, np.uint64), np.unique(window_anchors(some, 8, 5)[2])
    given = np.unique(window_hashes(some, 8))
    out = _stretches(8, 5, 4, common, given)((0,), texts, pd.DataFrame({"anchors": [none.tobytes()]}))
    sent = np.concatenate([np.frombuffer(x, np.int32) for x in out[out["kind"] == 0]["b"]])
    assert len(sent) == 23 and set(sent.tolist()) == {8}  # each window of the passage once, none with a context
    asked = _anchors(8, 5, 4, common, given)([pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([passage] * 2)], ["id", "text"])])
    assert not list(asked)


def test_repeated_words_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted((repr(r.id), r.n_words, r.n_removed, r.kept_sha256) for r in repeated_words(odd_docs, width=8).collect())
    assert got == brute_words(rows, 8)
    assert repeated_words(odd_docs.limit(0)).count() == 0


def brute_vectors(rows, near):
    ok = {}
    for k, (_, v, label) in enumerate(rows):
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            ok[k] = x / np.linalg.norm(x)
    links = {k: set() for k in range(len(rows))}
    for i, j in itertools.combinations(ok, 2):
        if rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]) and (rows[i][1] == rows[j][1] or ok[i] @ ok[j] >= near):
            links[i].add(j)
            links[j].add(i)
    found = roots(range(len(rows)), [(i, j) for i in links for j in links[i]])
    least = {}
    for k, root in found.items():
        if rows[k][0] is not None:
            least[root] = min(least.get(root, rows[k][0]), rows[k][0])
    return [(rows[k][0], len(links[k]), least.get(found[k])) for k in range(len(rows))]


def near_group(rng, centre, n, noise):
    return [(centre + noise * rng.standard_normal(len(centre))).astype(np.float32).tolist() for _ in range(n)]


def test_embeddings_recall_and_no_wrong_links(spark):
    rng = np.random.default_rng(8)
    vectors = [rng.standard_normal(32).astype(np.float32).tolist() for _ in range(500)]
    for n, noise in ((300, 0.1), (40, 0.14), (40, 0.05), (20, 0.0)):
        vectors += near_group(rng, rng.standard_normal(32), n, noise)
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.id: (r.n_links, r.component_id, r.kept) for r in embedding_classes(df, tile=(64, 128)).collect()}
    wanted = {i: (n, c) for i, n, c in brute_vectors(rows, 0.98)}
    assert len(got) == len(rows) and all(got[i][0] <= wanted[i][0] for i in got)
    assert sum(x[0] for x in got.values()) >= 0.95 * sum(x[0] for x in wanted.values()) > 10_000
    assert all(got[i][2] == (got[i][1] == i) for i in got)


@pytest.mark.parametrize("exact", [1000, 100])
def test_embeddings_of_several_lengths(spark, exact):
    rng = np.random.default_rng(9)
    vectors = []
    for length, n in ((32, 300), (16, 120), (8, 2), (5, 2)):
        vectors += [rng.standard_normal(length).astype(np.float32).tolist() for _ in range(n)]
        vectors += near_group(rng, rng.standard_normal(length), max(2, n // 10), 0.05)
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.id: (r.n_links, r.component_id) for r in embedding_classes(df, exact=exact).collect()}
    wanted = {i: (n, c) for i, n, c in brute_vectors(rows, 0.98)}
    for length in (32, 16):
        ids = [i for i, v, _ in rows if len(v) == length]
        found, most = (sum(x[i][0] for i in ids) for x in (got, wanted))
        assert 0.95 * most <= found <= most and most > 20 and (exact == 100 or found == most)
    assert all(got[i] == wanted[i] for i, v, _ in rows if len(v) < 16)


def test_vectors_without_good_codes_are_compared_with_all(spark, monkeypatch):
    rng = np.random.default_rng(10)
    assert learn(rng.standard_normal((50, 64)), 0.5, 0.999, 40, most=1) is None
    monkeypatch.setattr("llm.embedding_dedup.learn", lambda *a, **b: None)
    rows = [(i, v, 1) for i, v in enumerate(near_group(rng, rng.standard_normal(16), 200, 0.15))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.id, r.n_links, r.component_id) for r in embedding_classes(df, exact=10, tile=(32, 64)).collect())
    assert got == sorted(brute_vectors(rows, 0.98))


def test_embeddings_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.01], 1), (3, [1.0, 0.01], 1), (4, [1.0, 0.0], 2),
        (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1),
        (11, [], 1), (12, [1.0, 0.0, 0.0], 1), (13, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, None, None),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, id string")
    got = sorted(((r.id, r.n_links, r.component_id) for r in embedding_classes(df).collect()), key=repr)
    assert got == sorted(brute_vectors(rows, 0.98), key=repr)
    assert embedding_classes(df.limit(0)).count() == 0


def test_one_document_of_each_component(spark):
    """Rows that share an id are documents of their own; of repeated rows one stays."""
    a, b, c = ("the quick brown fox jumps over the lazy dog and runs on", "a wholly different text of some words here", "x y z")
    rows = [(1, a, "p"), (1, a, "q"), (2, a, "p"), (2, b, "p"), (3, c, "p"), (None, c, "p"), (None, "only one without id", "p"), (4, None, "p"), (4, "", "p"), (4, "", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    found = sorted(((r.doc_id, r.text) for r in one_per_component(docs).collect()), key=repr)
    assert found == sorted([(1, a), (2, b), (3, c), (None, "only one without id"), (4, None), (4, ""), (4, "")], key=repr)
    assert one_per_component(docs).columns == docs.columns and one_per_component(docs.limit(0)).count() == 0
