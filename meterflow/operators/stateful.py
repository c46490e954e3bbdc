"""Operators that keep state of their own for each key of a stream.

They need the RocksDB state store (``session.large_state``). The state of a key is a few values,
whatever the stream has brought. Rows of one key in one micro-batch are handled by one task, so the
source's limit of a micro-batch bounds what a task sees of a key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from datetime import timedelta
from operator import itemgetter

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterflow.functions.clock import duration
from meterflow.operators.points import CITY_FIELDS, CITY_MEASUREMENT
from meterflow.operators.series import DASHBOARD_TZ
from meterflow.schemas import TOTAL

_HOUR = 3600


def _as_micros(schema: T.StructType) -> T.StructType:
    """The schema with instants as whole numbers, which no time zone changes on the way to Python and back."""
    instant = T.TimestampType()
    return T.StructType([T.StructField(f.name, T.LongType() if f.dataType == instant else f.dataType) for f in schema.fields])


def _to_micros(df: DataFrame) -> list:
    return [F.unix_micros(f.name).alias(f.name) if f.dataType == T.TimestampType() else F.col(f"`{f.name}`") for f in df.schema.fields]


def _below(value: float, other: float) -> bool:
    """Less than, as in SQL: NaN is above all numbers."""
    return value < other or (math.isnan(other) and not math.isnan(value))


def _cells(struct) -> tuple:
    """The values of a struct column, which comes as a dict."""
    return tuple(struct.values()) if isinstance(struct, dict) else tuple(struct)


class _LastReading(StatefulProcessor):
    """State of a meter: the order and the register of its last report.

    Rows are meter, register and the cells of the report, those of the order at ``at``.
    """

    def __init__(self, state: T.StructType, at: Sequence[int], cells: Sequence[str]) -> None:
        self.schema, self.at, self.out = state, at, Row(*cells, "previous")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.last.get()  # None if there is none
        last = None if known is None else tuple(known)
        out, before = self.out, None if last is None else last[:-1]
        for now, row in sorted(((tuple([r[k] for k in self.at]), r) for r in rows), key=itemgetter(0)):
            reading = row[1]
            if last is not None:
                if now <= before:
                    continue
                if _below(reading, last[-1]):
                    yield out(*row[2:], float(last[-1]))
            before, last = now, (*now, reading)
        if last is not None:
            self.last.update(last)

    def close(self) -> None:
        pass


def rollback_stream(readings: DataFrame, register: str, order_by: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Reports of a stream whose cumulative reading is below the one before it of the same meter.

    The stream's form of :func:`~meterflow.operators.quality.detect_rollback` with a register, with
    the same rows as long as the stream comes in the order of ``order_by``. The reports of a micro-batch are put
    in order first. A report that is not after the last one of its meter that an earlier
    micro-batch brought has come too late: it is compared with nothing, and nothing with it. Reports without a
    reading, a meter, or any column of the order are left out. One row of state a meter.
    """
    whole = readings.dropna(subset=[register, "meterID", *order_by])
    plain = _as_micros(whole.schema)
    fields = {f.name: f.dataType for f in plain.fields}
    state = T.StructType([*[T.StructField(c, fields[c]) for c in order_by], T.StructField("reading", T.DoubleType())])
    if "reading" in order_by:
        raise ValueError("the order may not have a column named reading")
    # plain columns under names that no column of the reports has: a struct costs Python many times as much
    cells = [f"_cell_{k}" for k in range(len(plain.fields))]
    reports = whole.select(
        F.col("meterID").alias("meter"),
        F.col(register).cast("double").alias("reading"),
        *[c.alias(cell) for c, cell in zip(_to_micros(whole), cells, strict=True)],
    )
    out = T.StructType([*[T.StructField(cell, f.dataType) for cell, f in zip(cells, plain.fields, strict=True)], T.StructField("previous", T.DoubleType())])
    # the rows begin with the meter and the register
    at = [2 + whole.columns.index(c) for c in order_by]
    found = reports.groupBy("meter").transformWithState(_LastReading(state, at, cells), out, "Append", "None")
    named = [F.timestamp_micros(cell) if f.dataType == T.TimestampType() else F.col(cell) for cell, f in zip(cells, whole.schema.fields, strict=True)]
    return found.select(*[c.alias(f.name) for c, f in zip(named, whole.schema.fields, strict=True)], "previous")


class _Newest(StatefulProcessor):
    """State of a series: its newest point and when that leaves the table."""

    def __init__(self, payload: T.StructType, span: int) -> None:
        self.payload, self.span = payload, span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", T.StructType([T.StructField("micros", T.LongType()), *self.payload.fields]))

    def _change(self, key, point: tuple, live: bool) -> Row:
        return Row(series=key[0], micros=point[0], payload=dict(zip(self.payload.names, point[1:], strict=True)), live=live)

    def _leaves(self, micros: int) -> int:
        """The first millisecond at which the point is older than the span."""
        return (micros + self.span) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:  # only moves time on
            return
        known = tuple(self.newest.get()) if self.newest.exists() else None
        best = known
        for row in rows:
            if best is None or row["micros"] > best[0]:
                best = (row["micros"], *_cells(row["payload"]))
        if best is not known:
            if known is not None:
                self.handle.deleteTimer(self._leaves(known[0]))
            self.newest.update(best)
            self.handle.registerTimer(self._leaves(best[0]))
            yield self._change(key, best, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.newest.exists():
            last = tuple(self.newest.get())
            self.newest.clear()
            yield self._change(key, last, False)

    def close(self) -> None:
        pass


def _city_rows(points: DataFrame, watermark: int | str) -> DataFrame:
    """City points of a stream: time, series (null if the row only moves time on), tags and fields as columns."""
    city = F.col("tags")["cityID"]
    series = F.when(F.col("measurement") == CITY_MEASUREMENT, F.to_json(F.struct(city.alias("cityID"), F.col("tags")["cityName"].alias("cityName"))))
    return points.withWatermark("time", duration(watermark)).select(
        "time", F.when(city.isNotNull(), series).alias("series"), *[F.col("fields")[f].alias(f) for f in CITY_FIELDS]
    )


def _city_tags() -> list:
    tags = F.from_json("series", "cityID STRING, cityName STRING")
    return [tags["cityID"].alias("cityID"), tags["cityName"].alias("cityName")]


def live_city_map(points: DataFrame, span: timedelta = timedelta(seconds=40), watermark: int | str = "0 seconds") -> DataFrame:
    """The map of the newest point of each city, kept up to date by a stream of points.

    A row for each change, in update mode: a city's newest point with ``live``, and the same point without, once the
    watermark has left it ``span`` behind: a city that falls silent leaves the map and the state. :func:`map_now`
    makes the table of what is on the map. Of points of one city and time the first one counts. Rows without a city
    are no points, but move the watermark on, as a clock's ticks do. State: one point for each city that is live.
    """
    rows = _city_rows(points, watermark)
    payload = T.StructType([T.StructField(f, T.DoubleType()) for f in CITY_FIELDS])
    out = T.StructType([
        T.StructField("series", T.StringType()), T.StructField("micros", T.LongType()),
        T.StructField("payload", payload), T.StructField("live", T.BooleanType()),
    ])
    shaped = rows.select("time", "series", F.unix_micros("time").alias("micros"), F.struct(*CITY_FIELDS).alias("payload"))
    changes = shaped.groupBy("series").transformWithState(
        _Newest(payload, span // timedelta(microseconds=1)), out, "Update", "EventTime"
    )
    return changes.select(*_city_tags(), F.timestamp_micros("micros").alias("time"), "payload.*", "live")


def map_now(changes: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """What is on the map after all changes: the last one of each city, if it is live.

    ``order_by`` are the columns that tell which change is later, as the numbers of batches.
    """
    columns = [c for c in changes.columns if c not in order_by]
    # within a batch a city that comes back does so after it left
    order = F.struct(*order_by, "time", F.when(F.col("live"), 0).otherwise(1))
    last = changes.groupBy("cityID", "cityName").agg(F.max_by(F.struct(*columns), order).alias("last"))
    return last.select("last.*").where("live").drop("live")


class _Bars(StatefulProcessor):
    """State of a series and day: the sums of its hours, and the last hour that has a bar."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", "hour INT", "value DOUBLE")
        self.open = handle.getValueState("open", "hour INT")

    def _opened(self, key, upto: int) -> Iterator[Row]:
        """Bars without a sum for the hours from the last one that has a bar up to ``upto``, which has a timer after it."""
        last = self.open.get()[0] if self.open.exists() else -1
        if upto > last:
            for hour in range(last + 1, upto + 1):
                if not self.sums.containsKey((hour,)):
                    yield Row(series=key[0], second=key[1] + hour * _HOUR, value=None)
            self.open.update((upto,))
            self.handle.registerTimer(min(key[1] + (upto + 1) * _HOUR, key[2]) * 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:  # only moves time on
            return
        added: dict[int, float] = {}
        for row in rows:
            added[row["hour"]] = added.get(row["hour"], 0.0) + row["value"]
        for hour, value in added.items():
            before = self.sums.getValue((hour,))[0] if self.sums.containsKey((hour,)) else 0.0
            self.sums.updateValue((hour,), (before + value,))
            yield Row(series=key[0], second=key[1] + hour * _HOUR, value=before + value)
        if added:
            yield from self._opened(key, max(added))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.open.exists():  # another timer of this batch has closed the day
            return
        now = min(timerValues.getCurrentWatermarkInMs() // 1000, key[2] - 1)
        yield from self._opened(key, (now - key[1]) // _HOUR)
        if timerValues.getCurrentWatermarkInMs() >= key[2] * 1000:  # nothing of that day can come any more
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.sums.clear()
            self.open.clear()

    def close(self) -> None:
        pass


def live_hourly_bars(points: DataFrame, tz: str = DASHBOARD_TZ, watermark: int | str = "0 seconds") -> DataFrame:
    """Each city's sums by hour of the local day, kept up to date by a stream of points.

    A row for each bar that changes, in update mode; the newest row of a city and ``time`` (the start of the hour) counts. A
    city has bars from the day's first hour on as soon as it has a point that day; an hour without points gets a
    null one when the watermark reaches it. Hours are counted from local midnight, so a day has 23 to 25. A day's
    state goes when the watermark reaches its end. Points without a total have no value to add; rows
    without a city only move the watermark on.
    """
    local = F.date_trunc("day", F.from_utc_timestamp("time", tz))
    rows = _city_rows(points, watermark).select(
        "time",
        F.when(F.col(TOTAL).isNotNull(), F.col("series")).alias("series"),
        F.unix_timestamp(F.to_utc_timestamp(local, tz)).alias("midnight"),
        F.unix_timestamp(F.to_utc_timestamp(local + F.expr("INTERVAL 1 DAY"), tz)).alias("next"),
        F.col(TOTAL).alias("value"),
    )
    hour = F.floor((F.unix_timestamp("time") - F.col("midnight")) / _HOUR).cast("int").alias("hour")
    bars = (
        rows.select("time", "series", "midnight", "next", hour, "value")
        .groupBy("series", "midnight", "next")
        .transformWithState(_Bars(), "series STRING, second LONG, value DOUBLE", "Update", "EventTime")
    )
    return bars.select(*_city_tags(), F.timestamp_seconds("second").alias("time"), "value")
