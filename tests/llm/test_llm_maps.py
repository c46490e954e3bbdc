"""Decontamination and the classifier."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from llm import quality, words
from llm.decontamination import Searcher, decontaminated, edit_distance, leaks
from llm.queries import toxicity_grades

SMALL = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(words.WORD, (text or "").translate(LOW))


def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (w != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def brute_leaks(docs, items, similarity=0.8):
    out = {}
    for d, t in docs:
        text = split(t)
        for k, item in items:
            w = split(item)
            if w:
                cost = least_edits(w, text)
                if cost <= int((1 - similarity) * len(w) + 1e-9):
                    out[d, k] = cost
    return out


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(50):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 8))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 15))]
        cost, _ = edit_distance(np.array(item, dtype=np.uint64), np.array(text, dtype=np.uint64))
        assert cost == least_edits(item, text)


def edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[at] = f"e{rng.randrange(999)}"
        elif kind == 1:
            del w[at]
        else:
            w.insert(at, f"e{rng.randrange(999)}")
    return w


def test_leaks_against_brute_force(spark):
    rng = random.Random(2)
    items = [(k, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 4, 9, 15, 30, 45])))) for k in range(40)]
    docs = []
    for d in range(120):
        w = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(0, 60))]
        if d % 2:
            item = split(rng.choice(items)[1])
            at = rng.randrange(len(w) + 1)
            w[at:at] = edited(rng, item, rng.randrange(0, max(1, len(item) // 4) + 1))
        docs.append((d, " ".join(w).upper() if d % 3 else " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    wanted = brute_leaks(docs, items)
    got = {(r.id, r.item): r.edits for r in found}
    assert len(got) == len(found) and all(got[k] == wanted[k] for k in got)
    assert len(got) >= 0.95 * len(wanted) > 50


@pytest.mark.parametrize("kind", ["replaced", "inserted", "deleted", "mixed"])
def test_recall_at_the_bound_by_kind_of_edit(kind):
    """Given items with as many edits as they may have, among other words."""
    texts = pq.read_table("/root/testdata/sf0.1/benchmark.parquet").column("text").to_pylist()
    searcher = Searcher(list(range(len(texts))), texts, similarity=0.8, recall=0.99, samples=2, walks=12, worst=0.75)
    rng, docs, wanted = random.Random(kind), [], []
    for case in range(400):
        item = rng.randrange(len(texts))
        w = split(texts[item])
        for _ in range(searcher.edits[item]):
            how = kind if kind != "mixed" else rng.choice(["replaced", "inserted", "deleted"])
            at = rng.randrange(len(w))
            if how == "inserted":
                w.insert(max(1, at), f"z{rng.randrange(10**9)}")
            elif how == "deleted":
                del w[at]
            else:
                w[at] = f"z{rng.randrange(10**9)}"
        around = [[f"v{rng.randrange(5000)}" for _ in range(20)] for _ in range(2)]
        docs.append(" ".join([*around[0], *w, *around[1]]))
        wanted.append((case, item))
    found = set()
    for first, _, some in words.chunks(pa.array(docs), lower=True):
        found |= {(first + d, k) for d, k, *_ in searcher.hits(some)}
    same = {t: k for k, t in reversed(list(enumerate(texts)))}  # of equal items any one will do
    found = {(d, same[texts[k]]) for d, k in found}
    assert sum((d, same[texts[k]]) in found for d, k in wanted) >= 0.99 * len(wanted)


def test_given_leaks_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    wanted = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    got = {(r.id, r.item): r.edits for r in leaks(docs, items).collect()}
    assert got == wanted
    left = decontaminated(docs, items)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in wanted}
    assert {(r.id, r.item) for r in leaks(docs, items, batch_bytes=2000).collect()} == set(wanted)


def test_leaks_odd_rows(spark, odd_docs):
    schema = "item_id long, text string, id string"
    items = spark.createDataFrame([(1, "the quick brown fox jumps", "a"), (2, None, "a"), (3, "", None), (None, "one", "b")], schema)
    got = sorted((repr(r.id), repr(r.item)) for r in leaks(odd_docs, items).collect())
    assert got == sorted([("1", "1"), ("2", "1"), ("2", "1"), ("3", "1"), ("None", "1"), ("10", "None"), ("11", "None")])
    assert decontaminated(odd_docs, items).count() == odd_docs.count() - 7
    assert leaks(odd_docs, items.limit(0)).count() == 0 and decontaminated(odd_docs, items.limit(0)).count() == 13
    assert leaks(odd_docs.limit(0), items).count() == 0


def test_thresholds_are_ordered_and_held_out_grades_right():
    rng = random.Random(3)
    plain = [f"p{i}" for i in range(300)]

    def make(grade):
        w = [rng.choice(plain) for _ in range(40)]
        if grade == 0:
            w[rng.randrange(40)] = rng.choice(["vile", "nasty."])
        if grade == 1:
            w = [x + "###" if rng.random() < 0.4 else x for x in w]
        return " ".join(w)

    grades = [rng.choice([0, 1, 2, 2, 2]) for _ in range(1600)]
    texts = [make(g) for g in grades]
    doc, feature = [], []
    for first, _, some in words.chunks(pa.array(texts[:1200])):
        d, f = quality.feature_sets(some)
        doc.append(d + first)
        feature.append(f)
    model = quality.fit(np.concatenate(doc), np.concatenate(feature), np.array(grades[:1200]))
    assert model.thresholds[0] < model.thresholds[1] and model.grades == [0, 1, 2]
    score = np.concatenate([model.scores(some) for _, _, some in words.chunks(pa.array(texts[1200:]))])
    tails = model.tails(score)
    assert (tails[:, 0] >= tails[:, 1]).all()
    kept, good = tails[:, -1] >= quality.LEVEL, np.array(grades[1200:]) == 2
    assert (kept == good).mean() > 0.97


def plain_loss(w, cuts, sets, y, penalty):
    """The mean negative log-likelihood of the cumulative-link model with its ridge, document by document."""
    total = 0.0
    for some, grade in zip(sets, y, strict=True):
        score = sum(w.get(f, 0.0) for f in some)
        at_least = [1.0, *[1 / (1 + math.exp(c - score)) for c in cuts], 0.0]
        total -= math.log(max(at_least[grade] - at_least[grade + 1], 1e-12))
    return total / len(y) + penalty * sum(x * x for x in w.values()) / (2 * len(y))


def test_fit_is_the_minimum_of_the_plain_likelihood():
    """Against the plain model on a small sample: no weight or threshold can be moved to a clearly better fit."""
    rng = random.Random(4)
    sets, y = [], []
    for _ in range(400):
        grade = rng.choice([0, 1, 2])
        some = {rng.randrange(40) for _ in range(12)} | {50 + grade} if rng.random() < 0.8 else {rng.randrange(40) for _ in range(12)} | {50}
        sets.append(some)
        y.append(grade)
    doc = np.repeat(np.arange(400), [len(s) for s in sets])
    model = quality.fit(doc, np.array([f for s in sets for f in sorted(s)]), np.array(y), support=5, evidence=2.0, rounds=2000)
    w = {int(f): float(model.weights[f]) for f in np.flatnonzero(model.weights)}
    cuts = model.thresholds.tolist()
    assert {50, 51, 52} <= set(w) and cuts[0] < cuts[1]
    best = plain_loss(w, cuts, sets, y, 0.2)
    for f in w:
        for step in (-0.05, 0.05):
            assert plain_loss({**w, f: w[f] + step}, cuts, sets, y, 0.2) > best - 2e-4
    for k in range(2):
        for step in (-0.05, 0.05):
            moved = [c + step * (i == k) for i, c in enumerate(cuts)]
            assert plain_loss(w, moved, sets, y, 0.2) > best - 2e-4
    score = sum(w.get(f, 0.0) for f in sets[0])
    assert np.allclose(model.tails(np.array([score]))[0], [1 / (1 + math.exp(c - score)) for c in cuts])


def test_training_is_the_same_again(spark):
    """Ids with several texts: whatever the order of the rows, one of them is rated."""
    rows = [(i % 30, f"text {i} with words {i % 7}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratings = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, grade int")
    a, b = (quality.train(d, ratings) for d in (docs.repartition(1), docs.orderBy(F.desc("text")).repartition(5)))
    assert (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()


def test_selection_keeps_columns_and_odd_rows(spark, odd_docs):
    ratings = spark.createDataFrame([(1, 2), (3, 0), (3, 2), (None, 1), (4, None)], "doc_id long, grade int")
    model = quality.train(odd_docs, ratings)
    assert model.grades == [0, 2]
    rows = quality.judged(odd_docs, model).collect()
    assert len(rows) == 13 and all(0 <= r.tail_probability <= 1 for r in rows)
    assert quality.selected(odd_docs, model).columns == odd_docs.columns
    assert quality.train(odd_docs, ratings.limit(0)) is None
    assert quality.selected(odd_docs, None).count() == 13
    assert quality.judged(odd_docs, None).where("expected_grade IS NULL AND tail_probability = 1").count() == 13
    assert quality.judged(odd_docs.limit(0), model).count() == 0


def test_grades(spark):
    labels = spark.createDataFrame(
        [(1, 1, 1), (2, 0, 0), (3, 1, 0), (4, None, 0), (5, 1, None), (6, 0, 1)], "doc_id long, quality int, toxic int"
    )
    got = {r.doc_id: r.grade for r in toxicity_grades(labels).select("doc_id", F.col("grade").cast("int")).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: None, 5: None, 6: 0}
