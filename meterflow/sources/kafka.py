"""Kafka sources. They need Spark's Kafka package on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _kafka(reader, servers: str, topic: str, options: dict) -> DataFrame:
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """One topic as a stream, from the latest offsets unless ``startingOffsets`` says otherwise.

    ``maxOffsetsPerTrigger`` bounds a micro-batch; ``minPartitions`` splits a topic that
    has fewer partitions than the cluster has cores.
    """
    return _kafka(spark.readStream, servers, topic, options)


def read_kafka_batch(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options
) -> DataFrame:
    """All that a topic still holds."""
    return _kafka(spark.read, servers, topic, {"startingOffsets": starting, **options})
