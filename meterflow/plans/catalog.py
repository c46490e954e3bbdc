"""Every operator as a query over the given tables: name -> (session, folder) -> DataFrame."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow import jobs
from meterflow import operators as op
from meterflow.functions.clock import (
    as_instant,
    epoch_to_timestamp,
    local_midnight,
)
from meterflow.functions.columns import rename_by_regex
from meterflow.functions.messages import encode_json, parse_messages
from meterflow.operators.series import DASHBOARD_TZ
from meterflow.plans import tables
from meterflow.schemas import CITY_MESSAGE, COUNTRY_MESSAGE, HOURLY_MESSAGE, READING, TOTAL
from meterflow.session import large_state, register
from meterflow.shared import scratch_path, written_table
from meterflow.sources.files import read_city_dim, read_json_dump, write_snapshot
from meterflow.sources.store import (
    compact_hourly_store,
    read_hourly_store,
    read_month_totals,
    settled_months,
    update_month_totals,
    write_hourly_store,
)
from meterflow.streaming import job
from meterflow.streaming.committed import read_committed, write_committed
from meterflow.streaming.progress import batch_counts
from meterflow.streaming.sinks import (
    BATCH_ORDER,
    compact_points,
    read_batches,
    read_points,
    upsert_points,
    write_batches,
)

# The dashboard is looked at in the evening of this day.
AS_OF = as_instant("2024-01-15T18:30:00")
CITY = "NATION_7"
YEAR = 1997

# All days of the events are over then.
CLOSED = "2024-03-01 00:00:00"

CITY_KEYS = ["cityID", "cityName", "latitude", "longitude", "unix_window"]

# Event values are larger than meter deltas, and so are the bands they are checked with.
EVENT_BANDS = [(0, 6, 1.0, 20.0), (7, 8, 2.0, 30.0), (9, 16, 1.5, 25.0), (17, 23, 2.0, 40.0)]


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 5) for name in cols or (TOTAL,)})


def _averaged(df: DataFrame, *cols: str) -> DataFrame:
    """Averages often lie exactly between two roundings, so they are rounded as decimals."""
    return df.withColumns({
        name: F.round(F.col(name).cast("decimal(38,8)"), 5).cast("double") for name in cols
    })


def _windows(df: DataFrame) -> DataFrame:
    return _rounded(op.flat_window(df))


# windowed sums ---------------------------------------------------------------------------


def hourly_by_meter(spark, sf_dir):
    return _windows(op.hourly_by_meter(tables.readings(spark, sf_dir)))


def total_by_city(spark, sf_dir):
    return _windows(op.total_by_city(tables.readings(spark, sf_dir), tables.cities(spark, sf_dir)))


def total_by_city_all(spark, sf_dir):
    """A city table that lacks the northern cities; their totals are kept without a name."""
    known = tables.cities(spark, sf_dir).where("latitude < 43.45")
    return _windows(op.total_by_city(tables.readings(spark, sf_dir), known, how="left"))


def total_consumption(spark, sf_dir):
    return _windows(op.total_consumption(tables.readings(spark, sf_dir, with_city=False)))


def meter_window_sum(spark, sf_dir):
    """Fifteen-minute windows that begin five minutes past the quarter."""
    readings = tables.readings(spark, sf_dir, with_city=False)
    return _windows(op.windowed_sum(readings, ["meterID"], "15 minutes", start_time="5 minutes"))


def unix_window_sql_text(spark, sf_dir):
    """The hourly sum per meter as SQL text over a registered table."""
    register(tables.readings(spark, sf_dir, with_city=False), "meter_readings")
    return _windows(op.windowed_sum_sql(spark, "meter_readings", ["meterID"], 3600))


def hourly_untimed(spark, sf_dir):
    """Hourly sums where every seventh reading has lost its time."""
    time = F.when(F.col("readingID") % 7 != 0, F.col("timestamp"))
    return _windows(op.hourly_by_meter(tables.readings(spark, sf_dir).withColumn("timestamp", time)))


# messages --------------------------------------------------------------------------------


def parse_props(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").withColumnRenamed("props", "value_text")
    messages = events.select("event_id", F.col("value_text").cast("binary").alias("value"))
    return parse_messages(messages, "k BIGINT", keep=["event_id"])


def _reading_messages(spark, sf_dir, *kept):
    """Readings as JSON messages; those of error events are damaged on the way."""
    events = tables.table(spark, sf_dir, "events")
    body = F.to_json(F.struct(
        F.col("user_id").alias("meterID"),
        F.lit(1).alias("cityID"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("value").alias("activeDelta"),
    ))
    damaged = F.when(F.col("event_type") == "error", F.substr(body, F.lit(2))).otherwise(body)
    return events.select("event_id", *kept, damaged.cast("binary").alias("value"))


def parse_readings(spark, sf_dir):
    parsed = parse_messages(_reading_messages(spark, sf_dir), READING, keep=["event_id"])
    return epoch_to_timestamp(parsed).withColumn("timestamp", F.unix_timestamp("timestamp"))


def parse_quarantine(spark, sf_dir):
    messages = _reading_messages(spark, sf_dir, "event_type")
    parsed = parse_messages(messages, READING, quarantine=True, keep=["event_type"])
    status = F.when(F.col("complete"), "good").otherwise("bad").alias("status")
    return parsed.groupBy("event_type", status).agg(F.count("*").alias("n"))


def hourly_messages(spark, sf_dir):
    return encode_json(
        _rounded(op.hourly_by_meter(tables.readings(spark, sf_dir))), job.MESSAGE_KEYS[job.HOURLY]
    )


def city_messages(spark, sf_dir):
    """City totals to messages and back."""
    totals = op.total_by_city(tables.readings(spark, sf_dir), tables.cities(spark, sf_dir))
    messages = encode_json(totals, job.MESSAGE_KEYS[job.BY_CITY])
    return _windows(parse_messages(messages, CITY_MESSAGE, keep=["key"]))


# reconciliation and the hourly store -----------------------------------------------------


def reconcile_hourly(spark, sf_dir):
    return _rounded(op.flat_window(op.build_hourly_store(tables.hourly_partials(spark, sf_dir)))).drop("date")


def reconcile_latest(spark, sf_dir):
    """Falling totals, where only the newest partial is right."""
    falling = tables.hourly_partials(spark, sf_dir).withColumn(TOTAL, 0 - F.col(TOTAL))
    return _windows(op.reconcile(falling, how="latest", order_by="emitted"))


def store_rows_from_messages(spark, sf_dir):
    """Partial results as messages, and from them the rows of the hourly store by offset."""
    partials = tables.hourly_partials(spark, sf_dir)
    messages = partials.select(
        F.to_json(F.struct(*HOURLY_MESSAGE.fieldNames())).cast("binary").alias("value"),
        F.col("emitted").alias("offset"),
    )
    return _windows(jobs.store_rows(messages, how="latest")).drop("date")


def compact_latest(spark, sf_dir):
    messages = tables.readings(spark, sf_dir, with_city=False).select(
        F.col("meterID").cast("string").alias("key"),
        F.col("activeDelta").cast("string").alias("value"),
        F.col("readingID").alias("offset"),
    )
    return op.compact_latest(messages).withColumn("value", F.col("value").cast("double"))


def hourly_store_merge(spark, sf_dir):
    """Three overlapping runs into one store, the last one a repetition, and the store read back."""
    path = scratch_path(spark, "hourly-store")
    partials = written_table(tables.hourly_partials(spark, sf_dir), scratch_path(spark, "partials"))
    first = op.build_hourly_store(partials.where("emitted % 3600 < 2400"))
    second = op.build_hourly_store(partials.where("emitted % 3600 >= 600"))
    for number, run in enumerate((first, second, second)):
        write_hourly_store(run, path, run=number)
    return _windows(read_hourly_store(spark, path)).drop("date")


def hourly_store_compacted(spark, sf_dir):
    """Overlapping runs, settled month by month, and one more run on top."""
    path = scratch_path(spark, "compacted-store")
    partials = written_table(tables.hourly_partials(spark, sf_dir), scratch_path(spark, "partials"))
    write_hourly_store(op.build_hourly_store(partials.where("emitted % 3600 < 2400")), path, run=0)
    write_hourly_store(op.build_hourly_store(partials.where("emitted % 3600 < 3000")), path, run=1)
    for month in (1, 2):
        compact_hourly_store(spark, path, 2024, month)
    write_hourly_store(op.build_hourly_store(partials.where("emitted % 3600 >= 600")), path, run=2)
    return _windows(read_hourly_store(spark, path)).drop("date")


def hourly_store_settled(spark, sf_dir):
    """All months settled but the last, to which a run is added."""
    path = scratch_path(spark, "settled-store")
    partials = written_table(tables.hourly_partials(spark, sf_dir), scratch_path(spark, "partials"))
    write_hourly_store(op.build_hourly_store(partials), path)
    write_hourly_store(op.build_hourly_store(partials.where("emitted % 3600 < 2400")), path)
    for month in (1, 2):
        compact_hourly_store(spark, path, 2024, month)
    if not settled_months(spark, path):
        raise RuntimeError("no month is settled")
    return _windows(read_hourly_store(spark, path)).drop("date")


def yearly_from_totals(spark, sf_dir):
    """Yearly totals from monthly ones, which are kept for all orders but those of one hour; these come late."""
    path = scratch_path(spark, "orders-store")
    start = F.unix_timestamp("date")
    hist = tables.history(spark, sf_dir, with_city=False).withColumns({
        "cityID": F.lit(0).cast("long"), "unix_window": F.struct(start.alias("start"), (start + 3600).alias("end"))
    })
    hours = written_table(
        hist.groupBy("meterID", "cityID", "unix_window", "date", "hour", "year", "month").agg(F.sum(TOTAL).alias(TOTAL)),
        scratch_path(spark, "orders-hours"),
    )
    late = (F.col("hour") == 23) & (F.col("year") == YEAR)
    write_hourly_store(hours.where(~late), path)
    update_month_totals(spark, path)
    write_hourly_store(hours.where(late), path)
    update_month_totals(spark, path)
    return _rounded(op.yearly_by_meter(read_month_totals(spark, path)), "totalYearlyConsumption")


def hourly_store_append(spark, sf_dir):
    """Final hourly values appended once, and one year of them read back from its directories."""
    path = scratch_path(spark, "appended-store")
    final = op.build_hourly_store(op.hourly_by_meter(tables.readings(spark, sf_dir)))
    write_hourly_store(final, path, mode="append")
    return _windows(op.for_year(read_hourly_store(spark, path), 2024)).drop("date")


def json_snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshot-json")
    write_snapshot(op.hourly_by_meter(tables.readings(spark, sf_dir)), path, "json")
    return _windows(read_json_dump(spark, path, multiline=False, schema=HOURLY_MESSAGE))


def parquet_snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshot-parquet")
    write_snapshot(op.total_consumption(tables.readings(spark, sf_dir, with_city=False)), path, "parquet")
    return _windows(spark.read.parquet(path))


def city_table(spark, sf_dir):
    """The city table through its CSV form."""
    path = scratch_path(spark, "cities-csv")
    tables.cities(spark, sf_dir).write.option("header", True).csv(path)
    return _rounded(read_city_dim(spark, path), "latitude", "longitude")


# history ---------------------------------------------------------------------------------


def yearly_by_meter(spark, sf_dir):
    return _rounded(op.yearly_by_meter(tables.history(spark, sf_dir, with_city=False)), "totalYearlyConsumption")


def yearly_average(spark, sf_dir):
    return _averaged(op.yearly_average(tables.history(spark, sf_dir, with_city=False)), "averageYearlyConsumption")


def _compared(df):
    return _averaged(_rounded(df, "totalConsumptionInYear"), "averageYearlyConsumption")


def above_average(spark, sf_dir):
    hist = tables.history(spark, sf_dir, with_city=False, year=YEAR)
    return _compared(op.above_average_consumers(hist, YEAR))


def above_average_sql(spark, sf_dir):
    hist = tables.history(spark, sf_dir, with_city=False, year=YEAR)
    return _compared(op.above_average_sql(hist, YEAR))


def above_average_by_year(spark, sf_dir):
    return _compared(op.above_average_consumers(tables.history(spark, sf_dir, with_city=False)))


def top_consumers(spark, sf_dir):
    return _rounded(op.top_consumers(tables.history(spark, sf_dir, with_city=False)), "totalYearlyConsumption")


def top_consumers_per_year(spark, sf_dir):
    hist = tables.history(spark, sf_dir, with_city=False)
    return _rounded(op.top_consumers(hist, per_year=True), "totalYearlyConsumption")


def season_hour_profile(spark, sf_dir):
    profile = op.season_hour_profile(tables.history(spark, sf_dir, with_city=False))
    return _averaged(profile, "Winter", "Spring", "Summer", "Fall")


def daily_average(spark, sf_dir):
    return _averaged(op.daily_average(tables.history(spark, sf_dir, with_city=False)), "averageActiveDelta")


def daily_by_meter(spark, sf_dir):
    return _rounded(op.daily_by_meter(tables.readings(spark, sf_dir), DASHBOARD_TZ))


def daypart_profile(spark, sf_dir):
    profile = op.daypart_profile(tables.history(spark, sf_dir, with_city=False))
    return _averaged(_rounded(profile, "total"), "average")


# points and dashboard --------------------------------------------------------------------


def _city_points(spark, sf_dir, **range_):
    totals = op.total_by_city(tables.readings(spark, sf_dir, **range_), tables.cities(spark, sf_dir))
    return op.unpivot_fields(op.to_city_points(totals))


def _country_points(spark, sf_dir, **range_):
    totals = op.total_consumption(tables.readings(spark, sf_dir, with_city=False, **range_))
    return op.unpivot_fields(op.to_country_points(totals))


def _readings_of(start):
    """The reading times whose three-second windows end between ``start`` and the dashboard's time."""
    return {"start": start - timedelta(seconds=3), "stop": AS_OF}


def _today():
    return _readings_of(local_midnight(AS_OF, DASHBOARD_TZ))


def _series(df: DataFrame) -> DataFrame:
    """Points with plain columns: tags by name and epoch seconds."""
    return _rounded(
        df.withColumns({
            "cityID": F.col("tags")["cityID"],
            "cityName": F.col("tags")["cityName"],
            "time": F.unix_timestamp("time"),
        }).drop("tags"),
        "value",
    )


def city_points(spark, sf_dir):
    return _series(_city_points(spark, sf_dir))


def country_points(spark, sf_dir):
    return _series(_country_points(spark, sf_dir)).drop("cityID", "cityName")


def points_from_messages(spark, sf_dir):
    totals = op.total_by_city(tables.readings(spark, sf_dir), tables.cities(spark, sf_dir))
    return _series(op.unpivot_fields(jobs.city_points(encode_json(totals))))


def city_hourly_bars(spark, sf_dir):
    return _series(op.city_hourly_bars(_city_points(spark, sf_dir, **_today()), AS_OF)).drop("measurement", "field")


def country_hourly_bars(spark, sf_dir):
    bars = op.country_hourly_bars(_country_points(spark, sf_dir, **_today()), AS_OF)
    return _series(bars).select("time", "value")


def country_hourly_bars_unfilled(spark, sf_dir):
    bars = op.country_hourly_bars(_country_points(spark, sf_dir, **_today()), AS_OF, fill=False)
    return _series(bars).select("time", "value")


def last_per_series(spark, sf_dir):
    return _series(op.last_per_series(_city_points(spark, sf_dir)))


def city_map_latest(spark, sf_dir):
    span = timedelta(hours=12)
    points = _city_points(spark, sf_dir, **_readings_of(AS_OF - span))
    latest = op.city_map_latest(points, AS_OF, span)
    return _rounded(latest.withColumn("time", F.unix_timestamp("time")), TOTAL, "latitude", "longitude")


def city_series_today(spark, sf_dir):
    """One city today; the panel renames the value column after its field."""
    today = op.city_series_today(_city_points(spark, sf_dir, **_today()), CITY, AS_OF)
    labelled = _series(today).select("time", F.col("value").alias(f"{TOTAL} {CITY}"))
    return rename_by_regex(labelled, f"{TOTAL}.*", TOTAL)


def country_series_today(spark, sf_dir):
    today = op.country_series_today(_country_points(spark, sf_dir, **_today()), AS_OF)
    return _series(today).select("time", "value")


# quality ---------------------------------------------------------------------------------


def out_of_profile(spark, sf_dir):
    flagged = op.out_of_profile(tables.readings(spark, sf_dir, with_city=False), EVENT_BANDS)
    return _rounded(flagged.withColumn("timestamp", F.unix_timestamp("timestamp")), "lower", "upper")


def out_of_learnt_profile(spark, sf_dir):
    """Readings outside what is usual in their part of the day, by kept profiles of the months.

    A profile is exact up to the size of its sketch, here 65,535 readings of a month and part of the day.
    """
    readings = tables.readings(spark, sf_dir, with_city=False)
    profiles = written_table(op.month_profiles(readings, k=65_535), scratch_path(spark, "profiles"))
    flagged = op.out_of_learnt_profile(readings, op.learn_bounds(profiles, 0.02, 0.98))
    return flagged.withColumn("timestamp", F.unix_timestamp("timestamp"))


def rollback(spark, sf_dir):
    """Event values read as a register."""
    readings = tables.readings(spark, sf_dir, with_city=False)
    flagged = op.detect_rollback(readings, "activeDelta", ["timestamp", "readingID"])
    return flagged.select("readingID", "meterID", "activeDelta", "previous")


def negative_delta(spark, sf_dir):
    """Deltas between the value and 20, many of them negative."""
    shifted = tables.readings(spark, sf_dir, with_city=False).withColumn("activeDelta", F.col("activeDelta") - 20)
    return _rounded(op.detect_rollback(shifted), "activeDelta").select("readingID", "meterID", "activeDelta")


def diff_aggregates(spark, sf_dir):
    """Daily totals in UTC against daily totals in the dashboard's zone."""
    readings = tables.readings(spark, sf_dir)
    return op.diff_aggregates(
        op.daily_by_meter(readings, "UTC"), op.daily_by_meter(readings, DASHBOARD_TZ), ["meterID", "cityID", "date"]
    )


# streams ---------------------------------------------------------------------------------


def _file_sink(base: str, mode: str = "update") -> job.Sink:
    return lambda name, df, checkpoint: write_batches(df, f"{base}/{name}", checkpoint, mode=mode, available_now=True)


def _emitted(queries: dict, results: dict[str, DataFrame], base: str) -> dict[str, DataFrame]:
    """All that the queries emit up to the end of their input, which takes them several micro-batches."""
    for query in queries.values():
        query.awaitTermination()
    out = {}
    for name, df in results.items():
        out[name] = read_batches(df.sparkSession, f"{base}/{name}", df.schema)
        if out[name].select("batch").distinct().count() < 2:
            raise RuntimeError(f"{name} came in a single micro-batch")
    return out


def _streamed(spark: SparkSession, results: dict[str, DataFrame], mode: str = "update") -> dict[str, DataFrame]:
    """Run each result to the end of its input and return all that it emitted."""
    base = scratch_path(spark, "stream")
    start = _file_sink(base, mode)
    queries = {name: start(name, df, f"{base}/checkpoints/{name}") for name, df in results.items()}
    return _emitted(queries, results, base)


def stream_hourly(spark, sf_dir):
    emitted = _streamed(spark, {"hourly": op.hourly_by_meter(tables.readings_stream(spark, sf_dir))})
    return _windows(op.reconcile(emitted["hourly"]))


def stream_city(spark, sf_dir):
    totals = op.total_by_city(tables.readings_stream(spark, sf_dir), tables.cities(spark, sf_dir))
    return _windows(op.reconcile(_streamed(spark, {"city": totals})["city"], CITY_KEYS))


def stream_country(spark, sf_dir):
    totals = op.total_consumption(tables.readings_stream(spark, sf_dir, with_city=False))
    emitted = _streamed(spark, {"country": totals})["country"]
    return _windows(op.reconcile(emitted, ["unix_window"], "latest", order_by=BATCH_ORDER))


def stream_signed(spark, sf_dir):
    """Hourly totals that rise and fall: of what the batches emit only the newest is right."""
    readings = tables.readings_stream(spark, sf_dir, with_city=False)
    signed = readings.withColumn("activeDelta", F.col("activeDelta") - 20)
    emitted = _streamed(spark, {"signed": op.total_consumption(signed, "6 days", "6 days")})["signed"]
    if not emitted.groupBy("unix_window").count().where("count > 1").take(1):
        raise RuntimeError("no window was emitted twice")
    return _windows(op.reconcile(emitted, ["unix_window"], "latest", order_by=BATCH_ORDER))


def stream_late_rows(spark, sf_dir):
    """Country totals where every tenth event of the first 24 days comes after all others.

    Events arrive by eights of days. When the fifth part comes, rows are late whose window ended
    5 s or more before the last time seen two parts earlier: the watermark of a batch is that of
    the times before it, and what it evicts is held against the rows of the next one.
    """
    emitted = _streamed(spark, {"late": op.total_consumption(_late_readings(spark, sf_dir))})["late"]
    return _windows(op.reconcile(emitted, ["unix_window"]))


def _late_readings(spark, sf_dir):
    """Readings of which every tenth of the first 24 days comes after all others; see :func:`stream_late_rows`."""
    day = F.dayofmonth("ts")
    late = (F.col("event_id") % 10 == 0) & (day <= 24)
    arrival = F.when(late, 4).otherwise(F.least(F.floor((day - 1) / 8), F.lit(3)))
    return tables.readings_stream(spark, sf_dir, with_city=False, slices=5, arrival=arrival)


def stream_late_counts(spark, sf_dir):
    """How many windows each micro-batch brought too late."""
    base = scratch_path(spark, "late-counts")
    totals = op.total_consumption(_late_readings(spark, sf_dir))
    query = write_batches(totals, f"{base}/out", f"{base}/checkpoint", available_now=True)
    query.awaitTermination()
    return batch_counts(spark, query).where("late > 0").select("batch", "input_rows", F.col("late").alias("late_windows"))


def stream_repeated(spark, sf_dir):
    """Hourly sums of messages that each come twice, the second time up to 20 minutes later."""
    events = tables.table(spark, sf_dir, "events").withColumn("sent", F.col("ts"))
    twice = events.unionByName(events.withColumn("sent", F.expr("sent + make_dt_interval(0, 0, event_id % 21)")))
    number = tables.by_time(twice, "sent")
    arriving = tables.laid_out(twice, number, tables.SLICES, "repeated").drop("sent")
    readings = tables.as_readings(spark, sf_dir, arriving, lambda: op.hot_keys(twice, "user_id", number))
    sums = op.hourly_by_meter(op.without_repeats(readings, ["readingID"], "30 minutes"), watermark=None)
    return _windows(op.reconcile(_streamed(spark, {"repeated": sums})["repeated"]))


def stream_rollback(spark, sf_dir):
    """Event values read as a register, on a stream."""
    readings = tables.readings_stream(spark, sf_dir, with_city=False)
    with large_state(spark):
        flagged = op.detect_rollback(readings, "activeDelta", ["timestamp", "readingID"])
        emitted = _streamed(spark, {"rollback": flagged}, mode="append")["rollback"]
    return emitted.select("readingID", "meterID", "activeDelta", "previous")


def _arriving_points(spark, sf_dir):
    """City points before the dashboard's time as a stream, and a clock's tick at that time."""
    points = op.to_city_points(op.total_by_city(tables.readings(spark, sf_dir, stop=AS_OF), tables.cities(spark, sf_dir)))
    points = written_table(points.where(F.col("time") < F.lit(AS_OF)), scratch_path(spark, "city-points"))
    tick = spark.range(1).select(
        F.lit("tick").alias("measurement"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.create_map().cast("map<string,double>").alias("fields"),
        F.lit(AS_OF).alias("time"),
    )
    both = points.unionByName(tick)
    plain = both.select("measurement", F.to_json("tags").alias("tags"), F.to_json("fields").alias("fields"), "time")
    arriving = tables.laid_out(plain, tables.by_time(both, "time"), tables.SLICES, "point-slices")
    return arriving.select(
        "measurement",
        F.from_json("tags", "map<string,string>").alias("tags"),
        F.from_json("fields", "map<string,double>").alias("fields"),
        "time",
    )


def stream_city_map(spark, sf_dir):
    """The live map at the dashboard's time; cities leave it twelve hours after their last point."""
    with large_state(spark):
        changes = op.live_city_map(_arriving_points(spark, sf_dir), timedelta(hours=12))
        emitted = _streamed(spark, {"map": changes})["map"]
    now = op.map_now(emitted, BATCH_ORDER).withColumn("time", F.unix_timestamp("time"))
    return _rounded(now, TOTAL, "latitude", "longitude")


def stream_hourly_bars(spark, sf_dir):
    """Today's bars of each city, as they stand at the dashboard's time."""
    with large_state(spark):
        emitted = _streamed(spark, {"bars": op.live_hourly_bars(_arriving_points(spark, sf_dir))})["bars"]
    start = local_midnight(AS_OF, DASHBOARD_TZ)
    today = emitted.where(F.col("time") >= F.lit(start)).withColumn("time", F.unix_timestamp("time"))
    return _rounded(op.reconcile(today, ["cityID", "cityName", "time"], "latest", value="value", order_by=BATCH_ORDER), "value")


def stream_diff(spark, sf_dir):
    """Daily totals in UTC against those in the dashboard's zone, while both arrive."""
    readings = tables.readings(spark, sf_dir)

    def arriving(tz):
        daily = op.daily_by_meter(readings, tz).withColumn("day", F.to_timestamp("date"))
        daily = written_table(daily.select("meterID", "cityID", "date", "day", TOTAL), scratch_path(spark, "daily"))
        tick = spark.range(1).selectExpr(
            "cast(null as long) meterID", "cast(null as long) cityID", "cast(null as string) date",
            f"TIMESTAMP '{CLOSED}' day", f"cast(null as double) {TOTAL}",
        )
        number = tables.by_time(daily, "day")
        return tables.laid_out(daily.unionByName(tick), F.when(F.col("date").isNull(), tables.SLICES).otherwise(number), tables.SLICES + 1)

    differences = op.diff_streams(arriving("UTC"), arriving(DASHBOARD_TZ), ["meterID", "cityID", "date"], "day")
    return _streamed(spark, {"diff": differences}, mode="append")["diff"].drop("day", *BATCH_ORDER)


def _job_results(spark, sf_dir, name):
    """The whole streaming job, three queries side by side, and what one of them emitted."""
    base = scratch_path(spark, "job")
    readings, cities = tables.readings_stream(spark, sf_dir), tables.cities(spark, sf_dir)
    queries = job.start_queries(readings, cities, f"{base}/checkpoints", _file_sink(base))
    return _emitted(queries, job.aggregates(readings, cities), base)[name]


def stream_job_hourly(spark, sf_dir):
    return _windows(op.reconcile(_job_results(spark, sf_dir, job.HOURLY)))


def stream_job_city(spark, sf_dir):
    return _windows(op.reconcile(_job_results(spark, sf_dir, job.BY_CITY), CITY_KEYS))


def stream_job_country(spark, sf_dir):
    """As messages and back, as the job sends them."""
    emitted = _job_results(spark, sf_dir, job.COUNTRY)
    messages = encode_json(emitted.drop(*BATCH_ORDER), job.MESSAGE_KEYS[job.COUNTRY])
    return _windows(op.reconcile(parse_messages(messages, COUNTRY_MESSAGE), ["unix_window"]))


def _stored_points(points: DataFrame) -> str:
    """Points streamed into a point table."""
    base = scratch_path(points.sparkSession, "points")
    upsert_points(points, f"{base}/points", f"{base}/checkpoint", available_now=True).awaitTermination()
    return f"{base}/points"


def _streamed_city_points(spark, sf_dir):
    totals = op.total_by_city(tables.readings_stream(spark, sf_dir), tables.cities(spark, sf_dir))
    return _stored_points(op.to_city_points(totals))


def stream_points(spark, sf_dir):
    return _series(op.unpivot_fields(read_points(spark, _streamed_city_points(spark, sf_dir))))


def stream_points_committed(spark, sf_dir):
    """City totals as messages, and from them points through the sink that shows whole batches only."""
    totals = op.total_by_city(tables.readings(spark, sf_dir), tables.cities(spark, sf_dir))
    messages = written_table(
        encode_json(totals, job.MESSAGE_KEYS[job.BY_CITY]).withColumn("sent", F.timestamp_seconds(F.get_json_object("value", "$.unix_window.end").cast("long"))),
        scratch_path(spark, "city-messages"),
    )
    arriving = tables.laid_out(messages, tables.by_time(messages, "sent"), tables.SLICES, "message-slices")
    points, base = jobs.city_points(arriving), scratch_path(spark, "committed")
    write_committed(points, f"{base}/points", f"{base}/checkpoint", available_now=True).awaitTermination()
    stored = read_committed(spark, f"{base}/points", points.schema)
    city = [F.col("tags")[tag].alias(tag) for tag in ("cityID", "cityName")]
    newest = (
        stored.groupBy("measurement", *city, "time")
        .agg(F.max_by(F.struct("tags", "fields"), F.struct(*BATCH_ORDER)).alias("point"))
        .select("measurement", "point.tags", "point.fields", "time")
    )
    return _series(op.unpivot_fields(newest))


def stream_country_points(spark, sf_dir):
    totals = op.total_consumption(tables.readings_stream(spark, sf_dir, with_city=False))
    points = read_points(spark, _stored_points(op.to_country_points(totals)))
    return _series(op.unpivot_fields(points)).drop("cityID", "cityName")


def points_compacted(spark, sf_dir):
    """Some days settled, one of them twice, the others as the batches left them."""
    path = _streamed_city_points(spark, sf_dir)
    for day in ("2024-01-03", "2024-01-15", "2024-01-15"):
        if not compact_points(spark, path, day):
            raise RuntimeError(f"no points on {day}")
    return _series(op.unpivot_fields(read_points(spark, path)))


def stream_city_bars(spark, sf_dir):
    """From the stream through the point table to the bars of the dashboard."""
    path = _streamed_city_points(spark, sf_dir)
    points = op.unpivot_fields(read_points(spark, path, local_midnight(AS_OF, DASHBOARD_TZ), AS_OF))
    return _series(op.city_hourly_bars(points, AS_OF)).drop("measurement", "field")


QUERIES = {
    query.__name__: query
    for query in (
        hourly_by_meter,
        total_by_city,
        total_by_city_all,
        total_consumption,
        meter_window_sum,
        unix_window_sql_text,
        hourly_untimed,
        parse_props,
        parse_readings,
        parse_quarantine,
        hourly_messages,
        city_messages,
        reconcile_hourly,
        reconcile_latest,
        store_rows_from_messages,
        compact_latest,
        hourly_store_merge,
        hourly_store_compacted,
        hourly_store_settled,
        hourly_store_append,
        json_snapshot,
        parquet_snapshot,
        city_table,
        yearly_by_meter,
        yearly_from_totals,
        yearly_average,
        above_average,
        above_average_sql,
        above_average_by_year,
        top_consumers,
        top_consumers_per_year,
        season_hour_profile,
        daily_average,
        daily_by_meter,
        daypart_profile,
        city_points,
        country_points,
        points_from_messages,
        city_hourly_bars,
        country_hourly_bars,
        country_hourly_bars_unfilled,
        last_per_series,
        city_map_latest,
        city_series_today,
        country_series_today,
        out_of_profile,
        out_of_learnt_profile,
        rollback,
        negative_delta,
        diff_aggregates,
        stream_hourly,
        stream_city,
        stream_country,
        stream_signed,
        stream_late_rows,
        stream_late_counts,
        stream_repeated,
        stream_rollback,
        stream_city_map,
        stream_hourly_bars,
        stream_diff,
        stream_job_hourly,
        stream_job_city,
        stream_job_country,
        stream_points,
        stream_points_committed,
        stream_country_points,
        points_compacted,
        stream_city_bars,
    )
}
