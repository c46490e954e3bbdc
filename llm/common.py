"""Values that very many documents have, told from a sample so that no task has to gather them."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words
from llm.graph import packed, unpacked

#: Documents of the sample, about.
SAMPLE = 4_000
#: Share of the sampled documents from which on a value is common. There are at most as many common
#: values as the inverse of it times the values of a document.
SHARE = 0.02
#: Documents from which on a value is common whatever their share, so that a group is bounded in the largest table.
MOST = 2_000_000
_PARTS = 8

#: (the distinct values of some documents, document by document, the document of each)
Values = Callable[[words.Words], tuple[np.ndarray, np.ndarray]]


def _counted(values: Values, lower: bool, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, some in words.chunks(batch.column(0), lower=lower):
                found, count = np.unique(values(some)[0], return_counts=True)
                part = (found >> np.uint64(32)) % np.uint64(parts)
                rows = [(k, packed(found[part == k]), packed(count[part == k].astype(np.int64))) for k in range(parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32())] + [pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)],
                    ["part", "found", "count"],
                )

    return run


def _summed(least: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found, at = np.unique(unpacked(frame["found"], np.uint64), return_inverse=True)
        count = np.bincount(at, unpacked(frame["count"], np.int64)) if len(found) else np.zeros(0)
        return pd.DataFrame({"found": [packed(found[count >= least])]})

    return run


def common_values(
    docs: DataFrame, id: str, text: str, values: Values, lower: bool, share: float = SHARE, sample: int = SAMPLE, most: int = MOST
) -> np.ndarray:
    """The common values in ascending order.

    Callers may treat a value as common or not without changing a result: this only tells them
    which values to handle without bringing all their documents together. Common is what ``share`` of
    the documents or ``most`` of them have, whichever is less; the sample grows as that share shrinks. In
    tables of less than ``sample`` documents there are none.
    """
    n = docs.count()
    growth = max(1.0, share * n / most)
    share, sample = share / growth, math.ceil(sample * growth)
    if n < sample:
        return np.zeros(0, dtype=np.uint64)
    draw = F.pmod(F.xxhash64(id, text, F.lit(3)), F.lit(1_000_000)) < F.lit(int(1_000_000 * sample / n))
    buckets = math.ceil(_PARTS * growth)
    parts = (
        docs.where(draw)
        .select(F.col(text).alias("text"))
        .mapInArrow(_counted(values, lower, buckets), "part int, found binary, count binary")
        .groupBy("part")
        .applyInPandas(_summed(max(8.0, share * sample)), "found binary")
        .collect()
    )
    return np.sort(unpacked([r[0] for r in parts], np.uint64))


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of the values are among others that are in ascending order."""
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values
