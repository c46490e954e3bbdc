"""The given tables seen as readings, cities, hourly history and messages."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.clock import calendar_parts, unix_window
from meterflow.operators.enrich import hot_keys, lookup_join
from meterflow.schemas import CITY, TOTAL
from meterflow.shared import order_files, scratch_path

# Naming the types spares the job that would read them from a file.
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
CUSTOMER = "c_custkey BIGINT, c_nationkey INT"
ORDERS = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ"
NATION = "n_nationkey INT, n_name STRING"
SCHEMAS = {"events": EVENTS, "customer": CUSTOMER, "orders": ORDERS, "nation": NATION}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _between(col: str, start: datetime | None, stop: datetime | None) -> Column:
    """A range on the raw column, so that it reaches the scan."""
    condition = F.lit(True)
    if start is not None:
        condition &= F.col(col) >= F.lit(start.replace(tzinfo=None)).cast("timestamp_ntz")
    if stop is not None:
        condition &= F.col(col) < F.lit(stop.replace(tzinfo=None)).cast("timestamp_ntz")
    return condition


def _meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("meterID"), F.col("c_nationkey").cast("long").alias("cityID")
    )


def _as_readings(events: DataFrame, meters: DataFrame | None, hot: Callable[[], list] | None = None) -> DataFrame:
    readings = events.select(
        F.col("event_id").alias("readingID"),
        F.col("user_id").alias("meterID"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("activeDelta"),
    )
    if meters is None:
        return readings
    return lookup_join(readings, meters, "meterID", hot=hot).select(
        "readingID", "meterID", "cityID", "timestamp", "activeDelta"
    )


def as_readings(spark: SparkSession, sf_dir: str, events: DataFrame, hot: Callable[[], list] | None = None) -> DataFrame:
    """Events, also of a stream, as readings with their city; ``hot`` names the meters that have very many in a micro-batch."""
    return _as_readings(events, _meters(spark, sf_dir), hot)


def readings(
    spark: SparkSession,
    sf_dir: str,
    with_city: bool = True,
    start: datetime | None = None,
    stop: datetime | None = None,
) -> DataFrame:
    """Events as readings; without the city there is no join."""
    events = table(spark, sf_dir, "events").where(_between("ts", start, stop))
    return _as_readings(events, _meters(spark, sf_dir) if with_city else None)


#: Micro-batches that a stream of the given events comes in.
SLICES = 4
#: Rows of a file of such a stream, about.
FILE_ROWS = 2_000_000


def laid_out(df: DataFrame, number: Column, slices: int, name: str = "slices") -> DataFrame:
    """``df`` as a stream that arrives in parts by ``number``, from 0 up to ``slices`` - 1, a micro-batch each.

    Each part is written by one shuffle as as many files as its rows need, all parts as many as the
    largest, and a micro-batch takes the files of a part.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    numbered = df.withColumn("_number", number.cast("int"))
    largest = numbered.groupBy("_number").count().agg(F.max("count")).first()[0] or 0
    files = -(-largest // FILE_ROWS) or 1
    within = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files))
    numbered.repartitionById(slices * files, (F.col("_number") * files + within).cast("int")).drop("_number").write.parquet(path)
    order_files(spark, path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def by_time(df: DataFrame, time: str, slices: int = SLICES) -> Column:
    """Parts of ``df`` that are equally long in time."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    first, last = df.agg(F.min(micros), F.max(micros)).first()
    if first is None or first == last:
        return F.lit(0)
    return F.least(F.floor((micros - first) * slices / (last - first)), F.lit(slices - 1))


def readings_stream(
    spark: SparkSession, sf_dir: str, with_city: bool = True, slices: int = SLICES, arrival: Column | None = None
) -> DataFrame:
    """The same readings as a stream that arrives in ``slices`` parts, by their times or by the number ``arrival``."""
    events = table(spark, sf_dir, "events")
    number = by_time(events, "ts", slices) if arrival is None else arrival
    arriving = laid_out(events, number, slices, "event-slices")
    if not with_city:
        return _as_readings(arriving, None)
    return as_readings(spark, sf_dir, arriving, lambda: hot_keys(events, "user_id", number))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cities, at invented positions."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("cityID"),
        (42 + F.col("n_nationkey") * 0.1).cast("double").alias("latitude"),
        (16 + F.col("n_nationkey") * 0.1).cast("double").alias("longitude"),
        F.col("n_name").alias("cityName"),
    ).select(*CITY.fieldNames())


def history(
    spark: SparkSession, sf_dir: str, with_city: bool = True, year: int | None = None
) -> DataFrame:
    """Orders as hourly history.

    ``year`` only narrows the scan, with a day of slack, since a row is dated up to 23
    hours after its order; the exact filter stays with the caller.
    """
    start = None if year is None else datetime(year - 1, 12, 31)
    stop = None if year is None else datetime(year + 1, 1, 1)
    rows = table(spark, sf_dir, "orders").where(_between("o_orderdate", start, stop)).select(
        F.col("o_custkey").alias("meterID"),
        (
            F.col("o_orderdate").cast("timestamp")
            + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
        ).alias("date"),
        F.col("o_totalprice").alias(TOTAL),
    )
    rows = calendar_parts(rows, "date", "UTC")
    return lookup_join(rows, _meters(spark, sf_dir), "meterID") if with_city else rows


def hourly_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream with one-minute triggers emits for the hourly sums: running totals.

    Minutes are summed first, so a running total spans at most 60 rows.
    """
    minute = F.window("timestamp", "1 minute")["start"]
    hour = F.window(F.col("minute"), "1 hour")
    return (
        readings(spark, sf_dir)
        .groupBy("meterID", "cityID", minute.alias("minute"))
        .agg(F.sum("activeDelta").alias("total"))
        .withColumn("window", hour)
        .select(
            "meterID",
            "cityID",
            unix_window().alias("unix_window"),
            F.unix_timestamp("minute").alias("emitted"),
            F.expr(
                "sum(total) OVER (PARTITION BY meterID, cityID, window.start ORDER BY minute)"
            ).alias(TOTAL),
        )
    )
