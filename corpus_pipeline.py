"""From raw documents to a training mix: five stages, each written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm.decontamination import decontaminated
from llm.jaccard_join import one_per_component
from llm.line_dedup import DENSE, deduplicated_lines
from llm.mixing import mixed_documents
from llm.quality import selected, train
from llm.queries import ship, table, toxicity_grades
from meterflow.session import make_adaptive
from meterflow.shared import drop_scratch, remove_path, scratch_mark, scratch_path, written_table


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier expects to be of the highest grade."""
    ship(make_adaptive(spark))
    return selected(docs, train(docs, toxicity_grades(table(spark, sf_dir, "labels"))))


def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that an earlier one has."""
    make_adaptive(spark)  # a window of lines that very many documents have is split among tasks
    return deduplicated_lines(docs, spacing=DENSE)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    ship(make_adaptive(spark))
    return one_per_component(docs)


def _benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    ship(make_adaptive(spark))
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", _quality),
    ("line dedup", _lines),
    ("n-gram Jaccard join", _near),
    ("benchmark decontamination", _benchmark),
    ("mixing sources", _mix),
]

#: The classifier, the near copies and the edit distances have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written to the shared folder before it is used.

    Once it is written, the tables that the stage worked with are dropped, and the result before it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        since = scratch_mark()
        result = written_table(stage(spark, docs, sf_dir), path := scratch_path(spark, name.replace(" ", "-")))
        drop_scratch(spark, since, keep=path)
        if before is not None:
            remove_path(spark, before)
        docs, before = result, path
    return docs
