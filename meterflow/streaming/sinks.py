"""Where a stream ends."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from meterflow.functions.clock import as_instant
from meterflow.schemas import POINT
from meterflow.session import adaptive_execution
from meterflow.shared import child_names, claim_name, file_names, files_digest, of_one_job, path_exists, remove_path

# Order of the rows that batches left behind: later generations, then later batches.
BATCH_ORDER = ("generation", "batch")

#: Parts that the rows of a batch are dealt to before they are written. AQE joins small ones and splits large ones, so this
#: bounds neither files nor rows; each of the stream's tasks, often hundreds, opens a file for every part.
_PARTS = 32

_BATCH_COLUMNS = T.StructType([
    T.StructField("generation", T.IntegerType()),
    T.StructField("batch", T.LongType()),
])
_STORED_POINT = T.StructType([
    T.StructField("series", T.StringType()),
    *POINT.fields,
    *_BATCH_COLUMNS.fields,
    T.StructField("date", T.DateType()),
])


def checkpointed(writer: DataStreamWriter, root: str, name: str = "") -> DataStreamWriter:
    """Give a query its own checkpoint folder, ``root`` or ``root/name``."""
    return writer.option("checkpointLocation", f"{root.rstrip('/')}/{name}".rstrip("/"))


def triggered(writer: DataStreamWriter, available_now: bool) -> DataStreamWriter:
    """Process what is there and stop, or by default go on as soon as the last batch is done."""
    return writer.trigger(availableNow=True) if available_now else writer


def write_kafka_stream(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    mode: str = "update",
    available_now: bool = False,
    **options,
) -> StreamingQuery:
    """Send ``value`` (and ``key``) to a topic; each query needs a checkpoint of its own."""
    writer = (
        df.writeStream.outputMode(mode)
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
    )
    return triggered(checkpointed(writer, checkpoint), available_now).start()


def write_console(
    df: DataFrame, mode: str = "update", truncate: bool = False, available_now: bool = False
) -> StreamingQuery:
    """Print every micro-batch. A debugging aid."""
    writer = df.writeStream.outputMode(mode).format("console").option("truncate", truncate)
    return triggered(writer, available_now).start()


def write_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    mode: str = "update",
    partition_by: Sequence[str] = (),
    generation: int = 0,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep what every micro-batch emits, as Parquet in ``generation=G/batch=N``.

    A batch that is repeated after a failure replaces its own folder only, so nothing is
    lost or doubled. Batch numbers begin again with a new checkpoint: raise ``generation``
    then. Without that, a new checkpoint over an existing generation is refused.
    """
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/generation={generation}"
    if path_exists(spark, target) and not path_exists(spark, checkpoint):
        raise ValueError(f"{target} was written with another checkpoint; use a higher generation")

    def save(batch: DataFrame, batch_id: int) -> None:
        # Spark turns AQE off in the session of a stateful stream; this concerns the write only.
        with adaptive_execution(batch.sparkSession):
            (
                batch.hint("rebalance", _PARTS, *partition_by)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .partitionBy(*partition_by)
                .parquet(f"{target}/batch={batch_id}")
            )

    writer = checkpointed(df.writeStream.outputMode(mode), checkpoint).foreachBatch(save)
    return triggered(writer, available_now).start()


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Everything that :func:`write_batches` kept, with its ``generation`` and ``batch``."""
    return spark.read.schema(T.StructType([*schema.fields, *_BATCH_COLUMNS.fields])).parquet(path)


def _series_key() -> Column:
    """Measurement and tags as one text, whatever the order of the tags."""
    return F.to_json(F.struct("measurement", F.array_sort(F.map_entries("tags")).alias("tags")))


def _add_points(points: DataFrame, path: str) -> None:
    with adaptive_execution(points.sparkSession):
        (
            points.select(*_STORED_POINT.fieldNames())
            .hint("rebalance", _PARTS, "date")
            .write.mode("append")
            .partitionBy("date")
            .parquet(path)
        )


def upsert_points(
    points: DataFrame, path: str, checkpoint: str, *, generation: int = 0, available_now: bool = False
) -> StreamingQuery:
    """Store a stream of points; a later point of the same series and time replaces an earlier one.

    Batches only add files to the folders of their days, with the numbers of generation and batch
    in each row, and :func:`read_points` settles which point counts. Progress is committed after
    the write: a batch that is repeated adds the same points again, which changes nothing.
    Batch numbers begin again with a new checkpoint: raise ``generation`` then, else older points
    would win. :func:`compact_points` keeps the days small.
    """

    def save(batch: DataFrame, number: int) -> None:
        stored = batch.withColumns({
            "series": _series_key(),
            "generation": F.lit(generation),
            "batch": F.lit(number).cast("long"),
            "date": F.date_from_unix_date(F.floor(F.unix_seconds("time") / 86400).cast("int")),
        })
        _add_points(stored, path)

    return triggered(checkpointed(points.writeStream.outputMode("update"), checkpoint).foreachBatch(save), available_now).start()


def _newest(stored: DataFrame) -> DataFrame:
    """Of each series and time the point of the last batch. Grouped by a text, so that no map is sorted."""
    whole = F.struct(*BATCH_ORDER, "measurement", "tags", "fields")
    return (
        stored.groupBy("series", "time", "date")
        .agg(F.max_by(whole, F.struct(*BATCH_ORDER)).alias("point"))
        .select("series", "time", "date", "point.*")
    )


_SETTLED = "_settled"
_IN_DAY = re.compile(r"/date=([^/]+)/([^/]+)$")


def _day_files(spark: SparkSession, path: str) -> dict[str, set[str]]:
    days = defaultdict(set)
    for name in spark.read.schema(_STORED_POINT).parquet(path).inputFiles():
        if found := _IN_DAY.search(unquote(name)):
            days[found[1]].add(found[2])
    return days


def settled_days(spark: SparkSession, path: str) -> list[date]:
    """The days that were compacted and to which no batch has added since."""
    marks = set(child_names(spark, f"{path.rstrip('/')}/{_SETTLED}"))
    if not marks:
        return []
    return sorted(date.fromisoformat(d) for d, files in _day_files(spark, path).items() if f"{d}-{files_digest(files)}" in marks)


def read_points(
    spark: SparkSession, path: str, start: datetime | str | None = None, stop: datetime | str | None = None
) -> DataFrame:
    """The newest version of every stored point in ``[start, stop)``.

    The range opens the folders of its days (in UTC) only; points without a day are never left out
    for it. Settled days (:func:`settled_days`) are read as they are; in the others the newest version is looked for.
    """
    stored = spark.read.schema(_STORED_POINT).parquet(path)
    settled = settled_days(spark, path)
    unknown = F.col("date").isNull()
    if start is not None:
        start = as_instant(start)
        stored = stored.where((F.col("time") >= F.lit(start)) & (unknown | (F.col("date") >= F.lit(start.date()))))
    if stop is not None:
        stop = as_instant(stop)
        stored = stored.where((F.col("time") < F.lit(stop)) & (unknown | (F.col("date") <= F.lit(stop.date()))))
    columns = POINT.fieldNames()
    if not settled:
        return _newest(stored).select(*columns)
    closed = ~unknown & F.col("date").isin(settled)
    return _newest(stored.where(~closed)).select(*columns).unionByName(stored.where(closed).select(*columns))


def compact_points(spark: SparkSession, path: str, day: date | str) -> int:
    """Settle one day into few files; the number of files that it replaced.

    The settled points are added, with the numbers of their batches, before the files that were
    read are removed: the table says the same at every moment, also if the job is lost in between. Then the day is
    marked as settled, under a digest of its files, which any later batch changes.
    """
    day = date.fromisoformat(day) if isinstance(day, str) else day
    if not path_exists(spark, f"{path.rstrip('/')}/date={day}"):
        return 0
    here = spark.read.schema(_STORED_POINT).parquet(path).where(F.col("date") == F.lit(day))
    names = file_names(here)
    if names:
        _add_points(_newest(spark.read.schema(_STORED_POINT).option("basePath", path).parquet(*names)), path)
    for name in names:
        remove_path(spark, name)
    left = _day_files(spark, path).get(day.isoformat(), set())
    if of_one_job(left) and not left & {name.rsplit("/", 1)[1] for name in names}:
        claim_name(spark, f"{path.rstrip('/')}/{_SETTLED}/{day.isoformat()}-{files_digest(left)}")
    return len(names)
