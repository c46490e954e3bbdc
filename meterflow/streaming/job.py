"""The streaming job: one definition of the readings, three aggregates, three queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from meterflow.functions.clock import epoch_to_timestamp
from meterflow.functions.messages import encode_json, parse_messages
from meterflow.operators.windows import hourly_by_meter, total_by_city, total_consumption
from meterflow.schemas import READING
from meterflow.sources.files import read_city_dim
from meterflow.sources.kafka import read_kafka_stream
from meterflow.streaming.sinks import write_kafka_stream

HOURLY, BY_CITY, COUNTRY = "hourly", "by-city", "country"

# The topics.
INPUT_TOPIC = "input"
TOPICS = {
    HOURLY: "hourlyConsumptionByConsumer",
    BY_CITY: "totalByCity",
    COUNTRY: "totalConsumption",
}

#: Message key of each result; the country total has none.
MESSAGE_KEYS = {HOURLY: ["meterID", "unix_window"], BY_CITY: "cityID", COUNTRY: None}

#: Starts the query of one result: (name, aggregate, checkpoint folder).
Sink = Callable[[str, DataFrame, str], StreamingQuery]


@dataclass(frozen=True)
class StreamConfig:
    """Settings of the job."""

    servers: str
    city_path: str
    checkpoint_root: str
    input_topic: str = INPUT_TOPIC
    topics: dict[str, str] = field(default_factory=lambda: dict(TOPICS))
    source_options: dict[str, str] = field(default_factory=dict)
    available_now: bool = False


def read_readings(messages: DataFrame) -> DataFrame:
    """Readings with an event time from a frame of messages."""
    return epoch_to_timestamp(parse_messages(messages, READING))


def aggregates(readings: DataFrame, cities: DataFrame) -> dict[str, DataFrame]:
    """The three results by name."""
    return {
        HOURLY: hourly_by_meter(readings),
        BY_CITY: total_by_city(readings, cities),
        COUNTRY: total_consumption(readings),
    }


def start_queries(
    readings: DataFrame, cities: DataFrame, checkpoint_root: str, sink: Sink
) -> dict[str, StreamingQuery]:
    """Start one query per result, each with its own checkpoint and scheduler pool; they run side by side."""
    root = checkpoint_root.rstrip("/")
    context = readings.sparkSession.sparkContext
    started = {}
    try:
        for name, result in aggregates(readings, cities).items():
            context.setLocalProperty("spark.scheduler.pool", name)  # a query keeps that of its start
            started[name] = sink(name, result, f"{root}/{name}")
    finally:
        context.setLocalProperty("spark.scheduler.pool", None)
    return started


def kafka_sink(config: StreamConfig) -> Sink:
    def start(name: str, result: DataFrame, checkpoint: str) -> StreamingQuery:
        return write_kafka_stream(
            encode_json(result, MESSAGE_KEYS[name]),
            config.servers,
            config.topics[name],
            checkpoint,
            available_now=config.available_now,
        )

    return start


def await_any(spark: SparkSession, queries: dict[str, StreamingQuery]) -> None:
    """Return as soon as one query ends, stopping the others; its failure is raised here."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries.values():
            query.stop()
        spark.streams.resetTerminated()


def run_streams(spark: SparkSession, config: StreamConfig) -> None:
    """Read readings from Kafka and keep the three result topics up to date."""
    spark.streams.resetTerminated()
    messages = read_kafka_stream(spark, config.servers, config.input_topic, **config.source_options)
    cities = read_city_dim(spark, config.city_path)
    await_any(spark, start_queries(read_readings(messages), cities, config.checkpoint_root, kafka_sink(config)))
