"""The jobs, for spark-submit: ``python -m meterflow.jobs <job> --help``.

* ``stream`` keeps the three result topics up to date,
* ``hourly`` moves final hourly values from their topic into the hourly store,
* ``points`` keeps the point table up to date from the city and country topics,
* ``compact`` settles a closed month of the hourly store, or a day of points, into few files,
* ``totals`` keeps the store's monthly totals by meter up to date,
* ``consumers`` writes all consumers at or above the average of a year.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from meterflow.functions.messages import parse_messages
from meterflow.operators.consumption import above_average_consumers
from meterflow.operators.points import to_city_points, to_country_points
from meterflow.operators.reconcile import build_hourly_store
from meterflow.schemas import CITY_MESSAGE, COUNTRY_MESSAGE, HOURLY_MESSAGE
from meterflow.session import build_session, preview
from meterflow.sources.files import write_snapshot
from meterflow.sources.kafka import read_kafka_batch, read_kafka_stream
from meterflow.sources.store import (
    WriteReport,
    compact_hourly_store,
    read_month_totals,
    update_month_totals,
    write_hourly_store,
)
from meterflow.streaming.job import BY_CITY, COUNTRY, HOURLY, TOPICS, StreamConfig, await_any, run_streams
from meterflow.streaming.sinks import checkpointed, compact_points, triggered, upsert_points


def store_rows(messages: DataFrame, tz: str = "UTC", how: str = "max") -> DataFrame:
    """Rows of the hourly store from the messages of the hourly topic.

    ``latest`` goes by offset: messages of one key lie in one partition of the topic.
    """
    if how == "latest":
        return build_hourly_store(parse_messages(messages, HOURLY_MESSAGE, keep=["offset"]), tz, how, "offset")
    return build_hourly_store(parse_messages(messages, HOURLY_MESSAGE), tz, how)


def city_points(messages: DataFrame) -> DataFrame:
    """Points from the messages of the city topic."""
    return to_city_points(_timed(messages, CITY_MESSAGE))


def country_points(messages: DataFrame) -> DataFrame:
    """Points from the messages of the country topic."""
    return to_country_points(_timed(messages, COUNTRY_MESSAGE))


def _timed(messages: DataFrame, schema: StructType) -> DataFrame:
    """Messages that have a window; without one, as in a broken message, there is no point."""
    return parse_messages(messages, schema).where("unix_window.end IS NOT NULL")


def run_hourly(
    spark: SparkSession,
    servers: str,
    store: str,
    topic: str = TOPICS[HOURLY],
    tz: str = "UTC",
    mode: str = "merge",
    how: str = "max",
) -> WriteReport:
    """Everything the hourly topic holds, into the store. May be repeated at any time."""
    return write_hourly_store(store_rows(read_kafka_batch(spark, servers, topic), tz, how), store, mode)


def stream_hourly(
    messages: DataFrame, store: str, checkpoint: str, tz: str = "UTC", how: str = "max", available_now: bool = True
) -> StreamingQuery:
    """What is new in the hourly topic, into the store: goes on where the last run stopped.

    A micro-batch is a run of the store, and a repeated one has the number that it had before, so it says the
    same again. Runs of this job, of :func:`run_hourly` and of other checkpoints may take turns: the store numbers them all.
    """

    def save(batch: DataFrame, number: int) -> None:
        write_hourly_store(store_rows(batch, tz, how), store, label=f"{checkpoint}#{number}")

    return triggered(checkpointed(messages.writeStream, checkpoint), available_now).foreachBatch(save).start()


def run_points(spark: SparkSession, servers: str, path: str, checkpoint_root: str) -> None:
    """Both aggregate topics into the point table, until one of the two queries ends."""
    spark.streams.resetTerminated()
    queries = {}
    for name, to_points in ((BY_CITY, city_points), (COUNTRY, country_points)):
        points = to_points(read_kafka_stream(spark, servers, TOPICS[name], startingOffsets="earliest"))
        queries[name] = upsert_points(points, f"{path}/{name}", f"{checkpoint_root}/points-{name}")
    await_any(spark, queries)


def run_consumers(
    spark: SparkSession, store: str, output: str, year: int | None, fmt: str = "parquet", how: str = "max", rows: int = 0
) -> None:
    """All consumers at or above the average, written; ``rows`` of them are also printed. Monthly totals are used where they are kept."""
    write_snapshot(above_average_consumers(read_month_totals(spark, store, how), year), output, fmt)
    if rows:
        preview(spark.read.format(fmt).load(output), rows, truncate=False)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="meterflow", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    job("stream", "servers", "city-path", "checkpoint-root")
    hourly = job("hourly", "servers", "store")
    hourly.add_argument("--checkpoint", help="go on from here instead of reading the whole topic")
    hourly.add_argument("--tz", default="UTC")
    hourly.add_argument("--mode", default="merge", choices=["merge", "append"])
    hourly.add_argument("--how", default="max", choices=["max", "latest"])
    job("points", "servers", "path", "checkpoint-root")
    compact = job("compact")
    compact.add_argument("--store")
    compact.add_argument("--month", help="YYYY-MM, with --store")
    compact.add_argument("--points")
    compact.add_argument("--day", help="YYYY-MM-DD, with --points")
    compact.add_argument("--how", default="max", choices=["max", "latest"])
    totals = job("totals", "store")
    totals.add_argument("--how", default="max", choices=["max", "latest"])
    consumers = job("consumers", "store", "output")
    consumers.add_argument("--year", type=int)
    consumers.add_argument("--format", default="parquet", choices=["json", "parquet"])
    consumers.add_argument("--how", default="max", choices=["max", "latest"])
    consumers.add_argument("--preview", type=int, default=0, metavar="N", help="also print N rows")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"meterflow-{args.job}", large_state=args.job == "stream", fair_scheduling=args.job == "stream")
    if args.job == "stream":
        run_streams(spark, StreamConfig(args.servers, args.city_path, args.checkpoint_root))
    elif args.job == "hourly" and args.checkpoint:
        messages = read_kafka_stream(spark, args.servers, TOPICS[HOURLY], startingOffsets="earliest")
        stream_hourly(messages, args.store, args.checkpoint, args.tz, args.how).awaitTermination()
    elif args.job == "hourly":
        print(run_hourly(spark, args.servers, args.store, tz=args.tz, mode=args.mode, how=args.how))
    elif args.job == "points":
        run_points(spark, args.servers, args.path, args.checkpoint_root)
    elif args.job == "compact":
        if args.store:
            year, month = map(int, args.month.split("-"))
            print(compact_hourly_store(spark, args.store, year, month, args.how))
        if args.points:
            print(compact_points(spark, args.points, args.day))
    elif args.job == "totals":
        print(update_month_totals(spark, args.store, args.how))
    else:
        run_consumers(spark, args.store, args.output, args.year, args.format, args.how, args.preview)


if __name__ == "__main__":
    main()
