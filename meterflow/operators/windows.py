"""Event-time sums. Each works unchanged on a batch and on a stream.

Sums combine on the map side, so a meter or a window that holds much of the input
reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.clock import duration, interval_micros, unix_window
from meterflow.operators.enrich import enrich_city
from meterflow.schemas import TOTAL


def windowed_sum(
    df: DataFrame,
    keys: Sequence[str],
    window: int | str,
    watermark: int | str | None = None,
    start_time: int | str | None = None,
    *,
    time: str = "timestamp",
    value: str = "activeDelta",
) -> DataFrame:
    """Sum ``value`` per key and tumbling window.

    Windows are aligned to the epoch; ``start_time`` shifts them. Rows without an event
    time belong to no window. The watermark concerns streams only.
    """
    if df.isStreaming:
        if watermark is not None:
            df = df.withWatermark(time, duration(watermark))
        shift = None if start_time is None else duration(start_time)
        bucket = F.window(time, duration(window), startTime=shift).alias("window")
        bounds = unix_window()
    else:
        # The same windows, but grouped by a plain number instead of a struct, which the
        # hash aggregate handles faster.
        df = df.where(F.col(time).isNotNull())
        micros, width = F.unix_micros(time), interval_micros(window)
        bucket = (micros - F.pmod(micros - interval_micros(start_time or 0), width)).alias("_start")
        bounds = F.struct(
            F.unix_timestamp(F.timestamp_micros("_start")).alias("start"),
            F.unix_timestamp(F.timestamp_micros(F.col("_start") + width)).alias("end"),
        )
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias(TOTAL))
    return sums.select(*keys, bounds.alias("unix_window"), TOTAL)


def windowed_sum_sql(
    spark: SparkSession,
    view: str,
    keys: Sequence[str],
    seconds: int,
    *,
    time: str = "timestamp",
    value: str = "activeDelta",
) -> DataFrame:
    """:func:`windowed_sum` of a registered batch table, as a pipeline of SQL steps."""
    named = ", ".join(keys)
    return spark.sql(f"""
        FROM {view}
        |> WHERE {time} IS NOT NULL
        |> EXTEND unix_seconds({time}) AS second
        |> EXTEND second - pmod(second, {int(seconds)}) AS opened
        |> AGGREGATE sum({value}) AS {TOTAL} GROUP BY {named}, opened
        |> SELECT {named}, struct(opened AS start, opened + {int(seconds)} AS end) AS unix_window, {TOTAL}
    """)


def without_repeats(
    readings: DataFrame, keys: Sequence[str], watermark: int | str, *, time: str = "timestamp"
) -> DataFrame:
    """Each message of an at-least-once source once, known by its ``keys``.

    On a stream a repetition is recognised as long as the watermark is not past the time of the first one that
    came by more than ``watermark``, and so long its key is kept. Of repeated
    messages any one stays, so they should be equal; null keys are equal to each other.
    """
    if not readings.isStreaming:
        return readings.dropDuplicates(list(keys))
    return readings.withWatermark(time, duration(watermark)).dropDuplicatesWithinWatermark(list(keys))


def hourly_by_meter(readings: DataFrame, window: int | str = "1 hour", watermark: int | str = "30 minutes") -> DataFrame:
    """Consumption per meter, city and hour."""
    return windowed_sum(readings, ["meterID", "cityID"], window, watermark)


def total_by_city(
    readings: DataFrame,
    cities: DataFrame,
    window: int | str = 3,
    watermark: int | str = 5,
    how: str = "inner",
) -> DataFrame:
    """Consumption per city and window, with the name and position of the city."""
    totals = windowed_sum(readings, ["cityID"], window, watermark)
    return enrich_city(totals, cities, how).select(
        "cityID", "cityName", "latitude", "longitude", "unix_window", TOTAL
    )


def total_consumption(readings: DataFrame, window: int | str = 3, watermark: int | str = 5) -> DataFrame:
    """Consumption of the whole country per window."""
    return windowed_sum(readings, [], window, watermark)


def flat_window(df: DataFrame) -> DataFrame:
    """``unix_window`` as two plain columns, ``window_start`` and ``window_end``."""
    return df.withColumns({
        "window_start": F.col("unix_window.start"),
        "window_end": F.col("unix_window.end"),
    }).drop("unix_window")
