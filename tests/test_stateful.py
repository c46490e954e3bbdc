"""Operators with state of their own, on streams of a file per micro-batch."""

import json
import os
import time
from datetime import timedelta

import pytest
from helpers import epoch, rows
from pyspark.sql import functions as F

from meterflow import operators as op
from meterflow.operators.points import CITY_MEASUREMENT
from meterflow.session import large_state
from meterflow.streaming.progress import batch_counts, held_state
from meterflow.streaming.sinks import BATCH_ORDER, read_batches, write_batches

T0 = epoch("2024-01-01 10:00:00")


class Files:
    """A folder of JSON files; each becomes one micro-batch, oldest first."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.count = spark, folder, schema, 0
        os.makedirs(folder)

    def add(self, *records):
        path = self.folder / f"{self.count:04d}.json"
        path.write_text("\n".join(map(json.dumps, records)) + "\n")
        stamp = time.time() - 10_000 + self.count
        os.utime(path, (stamp, stamp))
        self.count += 1
        return self

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.folder))

    def batch(self):
        return self.spark.read.schema(self.schema).json(str(self.folder))


def run(df, folder, mode):
    with large_state(df.sparkSession):
        query = write_batches(df, str(folder / "out"), str(folder / "checkpoint"), mode=mode, available_now=True)
        query.awaitTermination()
    return read_batches(df.sparkSession, str(folder / "out"), df.schema), query


# rollback --------------------------------------------------------------------------------


def reports(spark, tmp_path):
    return Files(spark, tmp_path / "reports", "id LONG, meterID LONG, second LONG, register DOUBLE, note STRING")


def timed(df):
    return df.withColumn("timestamp", F.timestamp_seconds("second")).drop("second")


def report(id, meter, second, register, note=None):
    return {"id": id, "meterID": meter, "second": T0 + second if second is not None else None, "register": register, "note": note}


def flagged(df):
    return sorted((r.id, r.previous) for r in df.select("id", "previous").collect())


def test_rollback_on_a_stream_equals_the_batch(spark, tmp_path):
    feed = reports(spark, tmp_path)
    feed.add(report(1, 1, 0, 10.0), report(3, 1, 20, 30.0, "x"), report(2, 1, 10, 12.0), report(10, 2, 5, 7.0))
    feed.add(report(4, 1, 30, 5.0), report(5, 1, 40, 6.0), report(11, 2, 30, None), report(12, None, 30, 1.0), report(13, 2, None, 1.0))
    feed.add(report(14, 2, 60, 6.5), report(6, 1, 50, 5.5), report(7, 1, 50, 4.0))
    streamed, _ = run(op.detect_rollback(timed(feed.stream()), "register", ["timestamp", "id"]), tmp_path, "append")
    batch = op.detect_rollback(timed(feed.batch()), "register", ["timestamp", "id"])
    assert flagged(streamed) == flagged(batch) == [(4, 30.0), (6, 6.0), (7, 5.5), (14, 7.0)]
    assert rows(streamed.select(*batch.columns)) == rows(batch)


def test_reports_reach_python_as_plain_columns(spark, tmp_path):
    """A struct's cells cost Python several times as much."""
    flow = op.detect_rollback(timed(reports(spark, tmp_path).add(report(1, 1, 0, 10.0)).stream()), "register", ["timestamp", "id"])
    assert "struct(" not in flow._jdf.queryExecution().analyzed().toString()


def test_rollback_goes_on_from_the_checkpoint(spark, tmp_path):
    feed = reports(spark, tmp_path).add(report(1, 1, 0, 10.0), report(2, 2, 0, 3.0))
    flow = lambda: op.detect_rollback(timed(feed.stream()), "register", ["timestamp", "id"])
    assert flagged(run(flow(), tmp_path, "append")[0]) == []
    feed.add(report(3, 1, 60, 9.0), report(4, 2, 60, 4.0))
    assert flagged(run(flow(), tmp_path, "append")[0]) == [(3, 10.0)]
    state = held_state(spark, str(tmp_path / "checkpoint"), variable="last")
    assert sorted((r.key[0], r.value["reading"]) for r in state.collect()) == [(1, 9.0), (2, 4.0)]


def test_reports_out_of_order_are_not_compared(spark, tmp_path):
    feed = reports(spark, tmp_path).add(report(1, 1, 0, 10.0), report(2, 1, 100, 20.0))
    feed.add(report(3, 1, 50, 1.0))  # behind the last one: neither a rollback nor the new last
    feed.add(report(4, 1, 100, 2.0), report(2, 1, 100, 20.0), report(5, 1, 200, 21.0))  # a tie goes by id; a repetition is nothing new
    streamed, _ = run(op.detect_rollback(timed(feed.stream()), "register", ["timestamp", "id"]), tmp_path, "append")
    assert flagged(streamed) == [(4, 20.0)]


# points ----------------------------------------------------------------------------------


def point(city, second, total=1.0):
    tags = {"cityID": str(city), "cityName": f"C{city}"} if city is not None else {}
    fields = {"aggregatedActiveDelta": total, "latitude": 40.0 + (city or 0)} if total is not None else {"latitude": 1.0}
    return {"measurement": CITY_MEASUREMENT, "tags": tags, "fields": fields, "second": second}


def city_points(spark, tmp_path):
    return Files(spark, tmp_path / "points", "measurement STRING, tags MAP<STRING,STRING>, fields MAP<STRING,DOUBLE>, second LONG")


def with_time(df):
    return df.withColumn("time", F.timestamp_seconds("second")).drop("second")


def test_a_silent_city_leaves_the_map(spark, tmp_path):
    feed = city_points(spark, tmp_path)
    feed.add(point(1, T0), point(2, T0 + 10, 5.0), point(1, T0 + 3, 2.0))
    feed.add(point(1, T0 + 30, 3.0))
    feed.add(point(1, T0 + 55, 4.0))  # now city 2 has been silent for 45 s
    changes, query = run(op.live_city_map(with_time(feed.stream())), tmp_path, "update")
    seen = sorted((r.batch, r.cityID, r.aggregatedActiveDelta, r.live) for r in changes.collect())
    assert seen[:3] == [(0, "1", 2.0, True), (0, "2", 5.0, True), (1, "1", 3.0, True)]
    assert [s[1:] for s in seen[3:]] == [("1", 4.0, True), ("2", 5.0, False)]
    now = op.map_now(changes, BATCH_ORDER)
    assert [(r.cityID, r.cityName, r.aggregatedActiveDelta, r.latitude, r.longitude) for r in now.collect()] == [("1", "C1", 4.0, 41.0, None)]
    checkpoint = str(tmp_path / "checkpoint")
    assert [held_state(spark, checkpoint, batch=b, variable="newest").count() for b in (0, 1)] == [2, 2]
    assert [json.loads(r.key[0])["cityID"] for r in held_state(spark, checkpoint, variable="newest").collect()] == ["1"]


def test_the_map_at_the_edge_of_its_span(spark, tmp_path):
    """A point is on the map as long as it isn't older than the span, like in the batch's answer."""
    feed = city_points(spark, tmp_path).add(point(1, T0), point(2, T0 + 1), point(None, T0 + 40, None))
    changes, _ = run(op.live_city_map(with_time(feed.stream()), timedelta(seconds=40)), tmp_path, "update")
    on_map = {r.cityID for r in op.map_now(changes, BATCH_ORDER).collect()}
    points = op.unpivot_fields(with_time(feed.batch()).where("tags['cityID'] IS NOT NULL"))
    batch = op.city_map_latest(points, "2024-01-01T10:00:40", timedelta(seconds=40))
    assert on_map == {r.cityID for r in batch.collect()} == {"1", "2"}
    feed.add(point(None, T0 + 41, None))
    changes, _ = run(op.live_city_map(with_time(feed.stream()), timedelta(seconds=40)), tmp_path, "update")
    assert {r.cityID for r in op.map_now(changes, BATCH_ORDER).collect()} == {"2"}


def bars_of(emitted):
    last = op.reconcile(emitted, ["cityID", "time"], "latest", value="value", order_by=BATCH_ORDER)
    return {(r.cityID, r.second): r.value for r in last.select("cityID", F.unix_timestamp("time").alias("second"), "value").collect()}


def test_bars_of_hours_without_points(spark, tmp_path):
    day = epoch("2024-01-01 00:00:00")
    feed = city_points(spark, tmp_path)
    feed.add(point(1, day + 7300, 1.0), point(1, day + 7400, 2.0))
    feed.add(point(1, day + 7500, 0.5), point(2, day + 15000, 4.0))
    feed.add(point(None, day + 18000, None), point(1, day + 16000, None))
    emitted, _ = run(op.live_hourly_bars(with_time(feed.stream()), "UTC", 7200), tmp_path, "update")
    # the watermark is two hours behind: at 3:00 in the end, so city 1 has four bars and city 2 all up to its point
    expected = {("1", day + 3600 * h): {2: 3.5}.get(h) for h in range(4)} | {("2", day + 3600 * h): {4: 4.0}.get(h) for h in range(5)}
    assert bars_of(emitted) == expected


def test_bars_of_days_with_changed_clocks_and_their_state(spark, tmp_path):
    """The day of 31 March 2024 has 23 hours in Sarajevo, that of 27 October 25; their state goes with them."""
    feed = city_points(spark, tmp_path)
    starts = [epoch("2024-03-30 23:00:00"), epoch("2024-10-26 22:00:00")]
    for start in starts:
        feed.add(point(1, start + 100, 1.0))
        feed.add(point(None, start + 30 * 3600, None))
    emitted, _ = run(op.live_hourly_bars(with_time(feed.stream())), tmp_path, "update")
    bars = bars_of(emitted)
    for start, hours in zip(starts, (23, 25), strict=True):
        own = sorted(t for _, t in bars if start <= t < start + 26 * 3600)
        assert own == [start + 3600 * h for h in range(hours)]
        assert bars["1", start] == 1.0 and all(bars["1", t] is None for t in own[1:])
    for variable in ("sums", "open"):
        assert held_state(spark, str(tmp_path / "checkpoint"), variable=variable).count() == 0


# two streams -----------------------------------------------------------------------------


def sides(spark, tmp_path):
    return [Files(spark, tmp_path / name, "key LONG, second LONG, aggregatedActiveDelta DOUBLE") for name in ("actual", "expected")]


def total(key, second, value):
    return {"key": key, "second": second, "aggregatedActiveDelta": value}


def test_differences_while_results_arrive(spark, tmp_path):
    actual, expected = sides(spark, tmp_path)
    actual.add(total(1, T0, 1.0), total(2, T0, 2.0), total(3, T0, 3.0), total(None, T0, 1.0)).add(total(4, T0 + 60, 0.3))
    expected.add(total(1, T0, 1.000001), total(2, T0, 2.5), total(5, T0, 5.0), total(None, T0, 2.0)).add(total(4, T0 + 60, 0.1 + 0.2))
    for side in (actual, expected):
        side.add(total(None, T0 + 999, None))
    flow = lambda f: op.diff_streams(*[with_time(x) for x in f], ["key"], "time")
    out, _ = run(flow([actual.stream(), expected.stream()]), tmp_path, "append")
    found = sorted((r.key, r.actual, r.expected, r.status) for r in out.where("key IS NOT NULL").collect())
    assert found == [(2, 2.0, 2.5, "different"), (3, 3.0, None, "unexpected"), (5, None, 5.0, "missing")]
    assert [(r.actual, r.expected) for r in out.where("key IS NULL").collect()] == [(1.0, 2.0)]
    batch = op.diff_aggregates(with_time(actual.batch()), with_time(expected.batch()), ["key", "time"])
    assert rows(out.select(*batch.columns)) == rows(batch)


# losses and state ------------------------------------------------------------------------


def test_late_windows_are_counted_and_evicted_ones_gone(spark, tmp_path):
    feed = Files(spark, tmp_path / "readings", "meterID LONG, second LONG, activeDelta DOUBLE")
    reading = lambda second: {"meterID": 1, "second": T0 + second, "activeDelta": 1.0}
    feed.add(reading(0), reading(1)).add(reading(100)).add(reading(200)).add(reading(0), reading(4), reading(5), reading(201))
    totals = op.total_consumption(timed(feed.stream()))
    _, query = run(totals, tmp_path, "update")
    counts = {r.batch: r for r in batch_counts(spark, query).collect()}
    assert [counts[b].late for b in range(4)] == [0, 0, 0, 2]  # windows [0, 3) and [3, 6)
    assert counts[3].input_rows == 4 and sum(c.removed for c in counts.values()) == 2
    held = held_state(spark, str(tmp_path / "checkpoint"))
    starts = {int(r.key["window"]["start"].timestamp()) for r in held.collect()}
    assert starts == {T0 + 198, T0 + 201}
    assert held_state(spark, str(tmp_path / "checkpoint"), batch=0).count() == 1


@pytest.mark.parametrize("later", [0, 1])
def test_repeated_messages_count_once(spark, tmp_path, later):
    feed = Files(spark, tmp_path / "messages", "id LONG, meterID LONG, cityID LONG, second LONG, activeDelta DOUBLE")
    message = lambda id, second: {"id": id, "meterID": 1, "cityID": 1, "second": T0 + second, "activeDelta": float(id)}
    first, second, third = message(1, 0), message(2, 600), message(4, 20_000)
    if later:
        feed.add(first, second).add(first, second, message(3, 700)).add(third).add(message(5, 20_001))
    else:
        feed.add(first, first, second, second).add(message(3, 700)).add(third, third).add(message(5, 20_001))
    readings = op.without_repeats(timed(feed.stream()), ["id"], "30 minutes")
    emitted, query = run(op.hourly_by_meter(readings, watermark=None), tmp_path, "update")
    sums = op.reconcile(emitted).select("unix_window.start", "aggregatedActiveDelta")
    assert rows(sums) == rows(op.reconcile(op.hourly_by_meter(timed(feed.batch().dropDuplicates()))).select("unix_window.start", "aggregatedActiveDelta"))
    held = [batch_counts(spark, query).where(f"operator = {o}").orderBy(F.desc("batch")).first().state_rows for o in (0, 1)]
    assert sorted(held) == [1, 2]  # the keys of the first hour have gone
