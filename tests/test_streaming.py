import json
import os
import time

import pytest
from helpers import cities, epoch, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from meterflow import operators as op
from meterflow.functions import encode_json
from meterflow.operators.enrich import hot_keys, lookup_join
from meterflow.schemas import POINT, READING
from meterflow.sources.kafka import read_kafka_batch, read_kafka_stream
from meterflow.streaming import job, sinks
from meterflow.streaming.sinks import (
    BATCH_ORDER,
    compact_points,
    read_batches,
    read_points,
    upsert_points,
    write_batches,
)

T0 = epoch("2024-01-01 10:00:00")


class Feed:
    """A folder of message files; each file becomes one micro-batch, oldest first."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        os.makedirs(folder)

    def add(self, *readings):
        lines = [
            r if isinstance(r, str)
            else json.dumps(dict(zip(("meterID", "cityID", "timestamp", "activeDelta"), r)))
            for r in readings
        ]
        path = self.folder / f"{self.files:04d}.txt"
        path.write_text("\n".join(lines) + "\n")
        stamp = time.time() - 10_000 + self.files
        os.utime(path, (stamp, stamp))
        self.files += 1
        return self

    def stream(self):
        return job.read_readings(
            self.spark.readStream.option("maxFilesPerTrigger", 1).text(str(self.folder))
        )

    def batch(self):
        return job.read_readings(self.spark.read.text(str(self.folder)))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "input")


def run(df, tmp_path, name="out", **options):
    path = str(tmp_path / name)
    write_batches(df, path, str(tmp_path / f"{name}-checkpoint"), available_now=True, **options).awaitTermination()
    return read_batches(df.sparkSession, path, df.schema)


def flat(df, *extra):
    return rows(op.flat_window(df).select(*extra, "window_start", "aggregatedActiveDelta"))


def test_update_mode_emits_running_sums(spark, feed, tmp_path):
    feed.add((1, 1, T0, 1.0)).add((1, 1, T0 + 1, 0.5), "broken").add((1, 1, T0 + 2, 2.0))
    emitted = run(op.total_consumption(feed.stream(), window=60), tmp_path)
    assert rows(emitted.select("batch", "aggregatedActiveDelta")) == [(0, 1.0), (1, 1.5), (2, 3.5)]


@pytest.mark.parametrize("large_state", [False, True])
def test_reconciled_stream_equals_batch(spark, feed, tmp_path, large_state):
    for b in range(4):
        feed.add(*[(m, m % 3, T0 + 600 * b + 37 * m, 0.25 * (m + b + 1)) for m in range(20)])
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    if large_state:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    try:
        for name, build in {
            "hourly": op.hourly_by_meter,
            "city": lambda r: op.total_by_city(r, cities(spark), window=600, watermark=1200),
            "country": lambda r: op.total_consumption(r, window=600, watermark=1200),
        }.items():
            emitted = run(build(feed.stream()), tmp_path, name)
            batch = build(feed.batch())
            keys = [c for c in batch.columns if c != "aggregatedActiveDelta"]
            for how in ({"how": "max"}, {"how": "latest", "order_by": BATCH_ORDER}):
                assert rows(op.reconcile(emitted, keys, **how).select(*batch.columns)) == rows(batch)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def late_feed(feed):
    """A jump in event time, then rows behind the watermark in the next batch and in the one after."""
    feed.add((1, 1, T0, 1.0))
    feed.add((1, 1, T0 + 100, 1.0))
    feed.add((1, 1, T0, 10.0), (1, 1, T0 + 96, 0.5))
    feed.add((1, 1, T0, 100.0), (1, 1, T0 + 100, 0.25))
    return feed


@pytest.mark.parametrize("multiple,total_of_first_window", [(True, 11.0), (False, 1.0)])
def test_late_rows(spark, feed, tmp_path, multiple, total_of_first_window):
    """Rows within the watermark count; the setting decides about the batch right after it moved."""
    late_feed(feed)
    setting = "spark.sql.streaming.statefulOperator.allowMultiple"
    spark.conf.set(setting, multiple)
    try:
        emitted = run(op.total_consumption(feed.stream()), tmp_path)
    finally:
        spark.conf.unset(setting)
    final = dict(flat(op.reconcile(emitted, ["unix_window"])))
    assert final[T0 // 3 * 3] == total_of_first_window
    assert final[(T0 + 96) // 3 * 3] == 0.5
    assert final[(T0 + 100) // 3 * 3] == 1.25


def test_a_small_batch_is_one_file_and_state_stays_as_planned(spark, feed, tmp_path):
    """AQE is on for the write only; the second batch finds the state of the first."""
    feed.add(*[(m, 1, T0, 1.0) for m in range(40)]).add(*[(m, 1, T0 + 1, 1.0) for m in range(40)])
    emitted = run(op.hourly_by_meter(feed.stream()), tmp_path)
    for batch in (0, 1):
        assert len(list((tmp_path / "out").glob(f"generation=0/batch={batch}/*.parquet"))) == 1
    assert rows(emitted.groupBy("batch").agg(F.sum("aggregatedActiveDelta"))) == [(0, 40.0), (1, 80.0)]
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_rows_without_an_event_time_are_not_counted(spark, feed, tmp_path):
    feed.add((1, 1, None, 5.0), "broken", (1, 1, T0, 1.0))
    assert flat(run(op.total_consumption(feed.stream()), tmp_path)) == [(T0, 1.0)]


def test_a_restart_goes_on_from_the_checkpoint(spark, feed, tmp_path):
    feed.add((1, 1, T0, 1.0))
    run(op.total_consumption(feed.stream()), tmp_path)
    feed.add((1, 1, T0 + 1, 2.0))
    emitted = run(op.total_consumption(feed.stream()), tmp_path)
    assert flat(op.reconcile(emitted, ["unix_window"])) == [(T0, 3.0)]


def test_a_new_checkpoint_needs_a_new_generation(spark, feed, tmp_path):
    feed.add((1, 1, T0, 1.0))
    df = op.total_consumption(feed.stream())
    path = str(tmp_path / "out")
    run(df, tmp_path)
    with pytest.raises(ValueError, match="generation"):
        write_batches(df, path, str(tmp_path / "other"))
    write_batches(df, path, str(tmp_path / "other"), generation=1, available_now=True).awaitTermination()
    assert rows(read_batches(spark, path, df.schema).select(*BATCH_ORDER)) == [(0, 0), (1, 0)]


def test_stored_points_are_replaced_by_later_batches(spark, feed, tmp_path):
    feed.add((1, 1, T0, 1.0), (2, 2, T0, 7.0)).add((1, 1, T0 + 1, 0.5)).add((1, 1, T0 + 86400, 3.0))
    points = op.to_city_points(op.total_by_city(feed.stream(), cities(spark)))
    path = str(tmp_path / "points")
    upsert_points(points, path, str(tmp_path / "c"), available_now=True).awaitTermination()
    stored = read_points(spark, path)
    assert stored.columns == POINT.fieldNames()

    def seen(df):
        return rows(df.select(F.col("tags")["cityName"], F.unix_timestamp("time"), F.col("fields")["aggregatedActiveDelta"]))

    assert seen(stored) == [("A", T0 + 3, 1.5), ("A", T0 + 86403, 3.0), ("B", T0 + 3, 7.0)]
    assert seen(read_points(spark, path, start="2024-01-02T00:00:00")) == [("A", T0 + 86403, 3.0)]
    assert seen(read_points(spark, path, stop="2024-01-02T00:00:00")) == [("A", T0 + 3, 1.5), ("B", T0 + 3, 7.0)]
    for name in ("2024-01-01", "2024-01-02"):
        assert (tmp_path / "points" / f"date={name}").is_dir()
    later = read_points(spark, path, start="2024-01-02T00:00:00")
    assert {f.split("/")[-2] for f in later.inputFiles()} >= {"date=2024-01-02"}
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    before = seen(stored)
    assert compact_points(spark, path, "2024-01-01") == 2
    assert len(list((tmp_path / "points" / "date=2024-01-01").glob("*.parquet"))) == 1
    assert seen(read_points(spark, path)) == before
    assert [str(d) for d in sinks.settled_days(spark, path)] == ["2024-01-01"]
    settled = read_points(spark, path, stop="2024-01-02T00:00:00").where("date_trunc('day', time) = '2024-01-01'")
    assert len(settled.collect()) == 2
    # a later batch that adds to the day takes the mark back
    frame = spark.read.schema(sinks._STORED_POINT).parquet(path).where("date = '2024-01-01'").limit(1)
    sinks._add_points(frame, path)
    assert sinks.settled_days(spark, path) == [] and seen(read_points(spark, path)) == before
    assert compact_points(spark, path, "2024-01-01") == 2 and len(sinks.settled_days(spark, path)) == 1
    assert seen(read_points(spark, path, stop="2024-01-02T00:00:00")) == [("A", T0 + 3, 1.5), ("B", T0 + 3, 7.0)]
    assert compact_points(spark, path, "1999-01-01") == 0


def test_points_without_a_day_are_in_every_range(spark, tmp_path):
    """Also files that someone has rewritten without the folders of the days."""
    path = str(tmp_path / "points")
    frame = spark.sql("SELECT 'm' AS measurement, map('a', 'b') AS tags, map('v', 1.0D) AS fields, timestamp_seconds(100) AS time")
    frame.selectExpr("'s' AS series", "*", "0 AS generation", "0L AS batch").write.parquet(path)
    assert read_points(spark, path).count() == 1
    assert read_points(spark, path, "1970-01-01T00:00:00", "1970-01-02T00:00:00").count() == 1
    assert read_points(spark, path, "1970-01-01T00:02:00").count() == 0


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """A batch whose commit was lost is run again."""
    feed = Feed(spark, tmp_path / "input").add((1, 1, T0, 1.0))
    df = op.total_consumption(feed.stream())
    run(df, tmp_path)
    commits = tmp_path / "out-checkpoint" / "commits"
    for f in commits.iterdir():
        os.remove(f)
    emitted = run(df, tmp_path)
    assert rows(emitted.select("batch", "aggregatedActiveDelta")) == [(0, 1.0)]


def test_a_large_lookup_table_is_salted_in_a_stream(spark, feed, tmp_path):
    feed.add(*[(7 if i % 3 == 0 else i, 0, T0 + i, 1.0) for i in range(60)]).add((7, 0, T0, 5.0), (999, 0, T0, 1.0))
    dim = spark.range(60).selectExpr("id AS meterID", "id % 5 AS home")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        streamed = lookup_join(feed.stream(), dim, "meterID", salts=4)
        emitted = run(op.windowed_sum(streamed, ["home"], "1 hour", "1 hour"), tmp_path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    direct = op.windowed_sum(lookup_join(feed.batch(), dim, "meterID"), ["home"], "1 hour")
    assert rows(op.reconcile(emitted, ["home", "unix_window"])) == rows(direct)


def test_a_stream_copies_only_the_rows_of_hot_keys(spark, feed, tmp_path):
    feed.add(*[(7 if i % 3 == 0 else i, 0, T0 + i, 1.0) for i in range(60)]).add((7, 0, T0, 5.0), (None, 0, T0, 1.0))
    dim = spark.range(60).selectExpr("id AS meterID", "id % 5 AS home")
    parsed = feed.batch()
    part = F.when(F.col("timestamp") < F.timestamp_seconds(F.lit(T0 + 30)), 0).otherwise(1)
    assert hot_keys(parsed, "meterID", part, least=10) == [7]
    assert hot_keys(parsed, "meterID", part, least=30) == []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        direct = rows(op.windowed_sum(lookup_join(parsed, dim, "meterID"), ["home"], "1 hour"))
        for keys in ([7], []):
            streamed = lookup_join(feed.stream(), dim, "meterID", salts=4, hot=lambda keys=keys: keys)
            plan = streamed._jdf.queryExecution().analyzed().toString()
            assert ("explode(CASE WHEN" in plan) == bool(keys), plan
            emitted = run(op.windowed_sum(streamed, ["home"], "1 hour", "1 hour"), tmp_path, f"out{len(keys)}")
            assert rows(op.reconcile(emitted, ["home", "unix_window"])) == direct
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def file_sink(spark, tmp_path, available_now=True):
    def start(name, result, checkpoint):
        messages = encode_json(result, job.MESSAGE_KEYS[name])
        return write_batches(messages, str(tmp_path / "topics" / name), checkpoint, available_now=available_now)

    return start


def test_three_queries_from_one_definition(spark, feed, tmp_path):
    feed.add((1, 1, T0, 1.0), (2, 9, T0 + 1, 2.0)).add((1, 1, T0 + 3, 4.0))
    queries = job.start_queries(feed.stream(), cities(spark), str(tmp_path / "checkpoints"), file_sink(spark, tmp_path))
    for query in queries.values():
        query.awaitTermination()
    assert {p.name for p in (tmp_path / "checkpoints").iterdir()} == {"hourly", "by-city", "country"}
    read = {name: spark.read.parquet(str(tmp_path / "topics" / name)) for name in queries}
    hourly = rows(read["hourly"].where("batch = 1").select("key", "value"))
    assert hourly == [(
        f"{{1, {{{T0}, {T0 + 3600}}}}}",
        f'{{"meterID":1,"cityID":1,"unix_window":{{"start":{T0},"end":{T0 + 3600}}},"aggregatedActiveDelta":5.0}}',
    )]
    assert rows(read["by-city"].select("key").distinct()) == [("1",)]
    assert read["country"].columns == ["value", "generation", "batch"]
    assert json.loads(read["country"].where("batch = 1").first().value) == {
        "unix_window": {"start": T0 + 3, "end": T0 + 6}, "aggregatedActiveDelta": 4.0,
    }


def test_one_failed_query_ends_the_job(spark, feed, tmp_path):
    feed.add((1, 1, T0, 1.0))
    spark.streams.resetTerminated()
    sink = file_sink(spark, tmp_path, available_now=False)

    def start(name, result, checkpoint):
        if name == job.COUNTRY:
            result = result.withColumn("aggregatedActiveDelta", F.raise_error(F.lit("lost")).cast("double"))
        return sink(name, result, checkpoint)

    queries = job.start_queries(feed.stream(), cities(spark), str(tmp_path / "checkpoints"), start)
    with pytest.raises(StreamingQueryException):
        job.await_any(spark, queries)
    assert not any(query.isActive for query in queries.values())


def test_console(spark, feed):
    feed.add((1, 1, T0, 1.0), (1, 1, T0, 2.0))
    query = sinks.write_console(feed.stream(), mode="append", available_now=True)
    query.awaitTermination()
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2


class Recorder:
    """Stands in for a Kafka reader or writer, as the connector is not on the test classpath."""

    def __init__(self):
        self.seen = {}

    def _set(self, key):
        def setter(value=None, **options):
            self.seen[key] = options or value
            return self

        return setter

    def __getattr__(self, name):
        return self._set(name)

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        return self.seen

    def start(self):
        return self.seen


class Fake:
    def __init__(self):
        self.read = self.readStream = self.writeStream = Recorder()


def test_kafka_sources():
    assert read_kafka_stream(Fake(), "h:9092", "input", maxOffsetsPerTrigger="1000") == {
        "format": "kafka", "kafka.bootstrap.servers": "h:9092", "subscribe": "input", "maxOffsetsPerTrigger": "1000",
    }
    assert read_kafka_batch(Fake(), "h:9092", "hourly") == {
        "format": "kafka", "kafka.bootstrap.servers": "h:9092", "subscribe": "hourly", "startingOffsets": "earliest",
    }


def test_kafka_sink(spark, feed):
    assert sinks.write_kafka_stream(Fake(), "h:9092", "out", "/c/hourly") == {
        "outputMode": "update", "format": "kafka", "kafka.bootstrap.servers": "h:9092", "topic": "out",
        "checkpointLocation": "/c/hourly",
    }


def test_kafka_frame_to_readings(spark):
    frame = spark.createDataFrame(
        [(b"k", b'{"meterID": 1, "cityID": 2, "timestamp": 100, "activeDelta": 1.5}', "input", 0, 5)],
        "key binary, value binary, topic string, partition int, offset long",
    )
    df = job.read_readings(frame)
    assert df.columns == READING.fieldNames()
    assert rows(df.withColumn("timestamp", F.unix_timestamp("timestamp"))) == [(1, 2, 100, 1.5)]
