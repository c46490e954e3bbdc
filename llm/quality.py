"""Quality classifier: cumulative-link (proportional odds) regression on graded ratings.

A document is the set of hashed features of its whole text: its lower-cased words without
punctuation at their end, and the last three bytes of each word. One weight per feature is
shared by all grades; ordered thresholds between the grades turn a document's score into the
probability of each grade, hence the expected grade and the probability of at least a grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words

#: Labelled documents that a model is fitted on at most, the same ones at every run.
FIT_ROWS = 8_000
#: Feature space.
BITS = 18
#: The least probability of the highest grade with which a document is selected.
LEVEL = 0.35
_ENDING = np.zeros(256, dtype=bool)
_ENDING[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def features(some: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) for every word's stem and ending, repeats included."""
    if not len(some.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data, start, stop = some.data, some.starts, some.stops.copy()
    for _ in range(3):
        shorter = _ENDING[data[stop - 1]] & (stop - 1 > start)
        stop -= shorter
    power, inverse = words._power(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(words._LOWERED[data] * power[: len(data)], out=sums[1:])
    stem = words.mixed((sums[stop] - sums[start]) * inverse[start])
    tail = np.maximum(start, some.stops - 3)
    ending = words.mixed((sums[some.stops] - sums[tail]) * inverse[tail] + np.uint64(1))
    doc = np.repeat(np.arange(len(some)), some.counts())
    shift = np.uint64(64 - BITS)
    return np.concatenate([doc, doc]), np.concatenate([stem >> shift, ending >> shift]).astype(np.int64)


def feature_sets(some: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature), each once, by document."""
    doc, feature = features(some)
    key = np.unique((doc << BITS) | feature)
    return key >> BITS, key & ((1 << BITS) - 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    """``weights`` by feature, ``thresholds`` between consecutive grades."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(at least the grade after the threshold), a column for each threshold."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])

    def scores(self, some: words.Words) -> np.ndarray:
        doc, feature = features(some)
        used = self.weights[feature] != 0
        key = np.unique((doc[used] << BITS) | feature[used])
        return np.bincount(key >> BITS, self.weights[key & ((1 << BITS) - 1)], minlength=len(some))


def fit(
    doc: np.ndarray, feature: np.ndarray, grade: np.ndarray, support: int = 20, evidence: float = 8.0, rounds: int = 300,
    penalty: float = 0.2,
) -> OrdinalModel:
    """Fit by gradient steps with momentum (Adam) on the whole sample.

    ``doc``, ``feature``: the feature sets of the sample. Features in fewer than ``support``
    documents, or whose rate doesn't differ between grades by ``evidence`` standard errors,
    get no weight. ``penalty`` is the ridge on the weights.
    """
    grades = sorted(set(grade.tolist()))
    y = np.searchsorted(grades, grade)
    k, n = len(grades), len(grade)
    base = np.bincount(y, minlength=k) / max(1, n)
    total = np.bincount(feature, minlength=1 << BITS)
    chosen = np.zeros(1 << BITS, dtype=bool)
    for g in range(k):
        seen = np.bincount(feature[y[doc] == g], minlength=1 << BITS)
        expected = total * base[g]
        chosen |= np.abs(seen - expected) > evidence * np.sqrt(np.maximum(expected * (1 - base[g]), 1.0))
    chosen &= total >= support
    names = np.flatnonzero(chosen)
    column = np.cumsum(chosen) - 1
    used = chosen[feature]
    row, col = doc[used], column[feature[used]].astype(np.int32)
    del doc, feature, used
    share = 1 / n
    w, cut, gap = np.zeros(len(names)), 0.0, np.zeros(max(0, k - 2))
    first = [np.zeros_like(w), np.zeros(k - 1)]
    second = [np.zeros_like(w), np.zeros(k - 1)]
    theta = np.concatenate([[cut - (k - 2) / 2], gap])
    for step in range(1, rounds + 1):
        thresholds = theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))])
        score = np.bincount(row, w[col], minlength=n)
        tail = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - thresholds[None, :]), np.zeros((n, 1))], axis=1)
        p = np.maximum(tail[np.arange(n), y] - tail[np.arange(n), y + 1], 1e-12)
        slope = tail * (1 - tail)
        d_score = -share * (slope[np.arange(n), y] - slope[np.arange(n), y + 1]) / p
        d_cut = np.zeros((n, k + 1))
        d_cut[np.arange(n), y] += share * slope[np.arange(n), y] / p
        d_cut[np.arange(n), y + 1] -= share * slope[np.arange(n), y + 1] / p
        cuts = d_cut[:, 1:k].sum(axis=0)
        d_theta = np.concatenate([[cuts.sum()], [cuts[j + 1 :].sum() * np.exp(theta[j + 1]) for j in range(k - 2)]])
        for which, (value, slope_) in enumerate(
            ((w, np.bincount(col, d_score[row], minlength=len(w)) + penalty * w / n), (theta, d_theta))
        ):
            first[which] = 0.9 * first[which] + 0.1 * slope_
            second[which] = 0.99 * second[which] + 0.01 * slope_**2
            value -= 0.1 * (first[which] / (1 - 0.9**step)) / (np.sqrt(second[which] / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[names] = w
    return OrdinalModel(weights, theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))]), grades)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = []
        for _, _, some in words.chunks(batch.column(0)):
            doc, feature = feature_sets(some)
            bounds = np.searchsorted(doc, np.arange(len(some) + 1))
            sets += [feature[a:b].astype(np.int32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), batch.column(1), pa.array(sets, pa.binary())], ["rated", "grade", "features"]
        )


def train(
    docs: DataFrame, ratings: DataFrame, id: str = "doc_id", text: str = "text", grade: str = "grade", rows: int = FIT_ROWS
) -> OrdinalModel | None:
    """A model of the graded documents, or None without two grades.

    ``ratings`` (id, grade): the lowest grade of an id counts, null ids and grades don't. Of
    more than ``rows`` rated ids those with the smallest hashes are used, so that memory on the
    driver is bounded; the sample is sent to the tasks and only its documents are read closely. Where
    several texts have one id, that with the smallest hash is rated, so that reruns agree.
    """
    graded = (
        ratings.select(F.col(id).alias("rated"), F.col(grade).cast("long").alias("grade"))
        .where("rated IS NOT NULL AND grade IS NOT NULL")
        .groupBy("rated")
        .agg(F.min("grade").alias("grade"))
    )
    sample = graded.orderBy(F.xxhash64("rated"), "rated").limit(rows)
    texts = docs.select(F.col(id).alias("rated"), F.col(text).alias("text"))
    found = (
        texts.join(F.broadcast(sample), "rated")
        .groupBy("rated", "grade")
        .agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
        .select("least.text", "grade", "rated")
        .mapInArrow(_sampled, f"rated {sample.schema['rated'].dataType.simpleString()}, grade long, features binary")
        .collect()
    )
    found = [r[1:] for r in sorted(found, key=lambda r: r[0])]
    grades = np.array([r[0] for r in found], dtype=np.int64)
    if len(set(grades.tolist())) < 2:
        return None
    sets = [np.frombuffer(r[1], np.int32) for r in found]
    del found
    doc = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])
    return fit(doc, np.concatenate(sets), grades)


def _judged(model: OrdinalModel | None, level: float, column: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [np.zeros(0)]
            if model is None:
                expected, tail = np.full(batch.num_rows, np.nan), np.ones(batch.num_rows)
            else:
                for _, _, some in words.chunks(batch.column(column)):
                    score.append(model.scores(some))
                tails = model.tails(np.concatenate(score))
                steps = np.diff(np.array(model.grades, dtype=float))
                expected, tail = model.grades[0] + tails @ steps, tails[:, -1]
            if keep:
                yield batch.filter(pa.array(tail >= level))
            else:
                some = pa.array(expected, mask=np.isnan(expected))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), some, pa.array(tail)], ["id", "expected_grade", "tail_probability"]
                )

    return run


def judged(docs: DataFrame, model: OrdinalModel | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, expected_grade, tail_probability) of every document, the tail being that of the highest grade.

    An empty or null text has the score 0. Without a model the grade is null and the
    probability 1.
    """
    slim = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {dict(docs.dtypes)[id]}, expected_grade double, tail_probability double"
    return slim.mapInArrow(_judged(model, 0.0, 1, keep=False), schema)


def selected(docs: DataFrame, model: OrdinalModel | None, text: str = "text", level: float = LEVEL) -> DataFrame:
    """The documents, all columns unchanged, whose probability of the highest grade is at least ``level``."""
    return docs.mapInArrow(_judged(model, level, docs.columns.index(text), keep=True), docs.schema)
