"""What a stream lost, and what it still holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

_BATCHES = "batch LONG, operator INT, input_rows LONG, late LONG, state_rows LONG, removed LONG"


def batch_counts(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """(batch, operator, input_rows, late, state_rows, removed): a row for each micro-batch and operator with state.

    ``late`` is what the watermark kept out of the operator; a sum counts its groups, as rows are
    combined before. ``removed`` is what the watermark evicted. Spark remembers the last
    ``spark.sql.streaming.numRecentProgressUpdates`` reports (100 by default): ask more often than that.
    """
    rows = {}
    for report in query.recentProgress:
        for number, state in enumerate(report.stateOperators):
            rows[report.batchId, number] = (
                report.batchId, number, report.numInputRows, state.numRowsDroppedByWatermark, state.numRowsTotal, state.numRowsRemoved
            )
    return spark.createDataFrame(list(rows.values()), _BATCHES)


def held_state(
    spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None, variable: str | None = None
) -> DataFrame:
    """(partition, key, value): the state that an operator holds after a micro-batch, by default the last one.

    ``variable`` names a state variable of an operator with state of its own.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    state = reader.load(checkpoint)
    return state.select("partition_id", *[c for c in state.columns if c != "partition_id"])
