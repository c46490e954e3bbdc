"""Dashboard questions to unpivoted points (measurement, tags, field, time, value).

Every range ends at an explicit ``as_of``; nothing here reads the clock.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.clock import as_instant, duration, local_midnight, time_shift
from meterflow.functions.columns import drop_columns
from meterflow.operators.points import CITY_FIELDS, CITY_MEASUREMENT, COUNTRY_MEASUREMENT
from meterflow.schemas import TOTAL

# Fixed value: the zone in which the dashboard's day begins.
DASHBOARD_TZ = "Europe/Sarajevo"

_HOUR = 3600


def select_series(
    points: DataFrame, measurement: str, field: str | None = None, city: str | None = None
) -> DataFrame:
    """Points of one measurement, optionally of one field and of one city name."""
    chosen = points.where(F.col("measurement") == measurement)
    if field is not None:
        chosen = chosen.where(F.col("field") == field)
    if city is not None:
        chosen = chosen.where(F.col("tags")["cityName"] == city)
    return chosen


def since_local_midnight(points: DataFrame, as_of: datetime | str, tz: str = DASHBOARD_TZ) -> DataFrame:
    """Points from the start of the local day up to, and without, ``as_of``."""
    return points.where(
        (F.col("time") >= F.lit(local_midnight(as_of, tz))) & (F.col("time") < F.lit(as_instant(as_of)))
    )


def recent(points: DataFrame, as_of: datetime | str, span: int | str | timedelta = "40 seconds") -> DataFrame:
    """Points of the last ``span`` before ``as_of``."""
    stop = F.lit(as_instant(as_of))
    start = stop - F.expr(f"INTERVAL '{duration(span)}'")
    return points.where((F.col("time") >= start) & (F.col("time") < stop))


def hourly_bars(
    points: DataFrame, as_of: datetime | str, tz: str = DASHBOARD_TZ, fill: bool = True
) -> DataFrame:
    """Sum per series and hour of the local day, labelled with the start of the hour.

    Hours are counted from local midnight, so a day has 23 to 25 of them. With ``fill``,
    an hour without points of a series that has others that day gets a null sum. All
    hours of a series are summed side by side in one grouping.
    """
    start, stop = local_midnight(as_of, tz), as_instant(as_of)
    hours = math.ceil((stop - start).total_seconds() / _HOUR)
    today = since_local_midnight(points, as_of, tz).withColumn(
        "_hour", F.floor((F.unix_timestamp("time") - int(start.timestamp())) / _HOUR)
    )
    if hours == 0:
        sums = F.array().cast("array<double>")
    else:
        sums = F.array(*[F.sum(F.when(F.col("_hour") == hour, F.col("value"))) for hour in range(hours)])
    bars = (
        today.groupBy("measurement", "tags", "field")
        .agg(sums.alias("_sums"))
        .select("measurement", "tags", "field", F.posexplode("_sums").alias("_hour", "value"))
        .withColumn("time", F.timestamp_seconds((F.col("_hour") + 1) * _HOUR + int(start.timestamp())))
    )
    if not fill:
        bars = bars.where("value IS NOT NULL")
    return time_shift(bars, "time", "-1 hour").select("measurement", "tags", "field", "time", "value")


def last_per_series(points: DataFrame) -> DataFrame:
    """The newest point of every series and field."""
    return points.groupBy("measurement", "tags", "field").agg(
        F.max("time").alias("time"), F.max_by("value", "time").alias("value")
    )


def city_map_latest(
    points: DataFrame, as_of: datetime | str, span: int | str | timedelta = "40 seconds"
) -> DataFrame:
    """One row per city with the position and the value of its newest recent point."""
    newest = last_per_series(recent(select_series(points, CITY_MEASUREMENT), as_of, span))
    # At most one value per field: a pivot that needs no shuffle of its own.
    columns = [F.max(F.when(F.col("field") == name, F.col("value"))).alias(name) for name in CITY_FIELDS]
    rows = newest.groupBy("time", "tags").agg(*columns)
    named = rows.withColumns({"cityID": F.col("tags")["cityID"], "cityName": F.col("tags")["cityName"]})
    return drop_columns(named, ["tags"])


def city_series_today(
    points: DataFrame, city: str, as_of: datetime | str, tz: str = DASHBOARD_TZ
) -> DataFrame:
    """Today's totals of one city, in time order."""
    return since_local_midnight(select_series(points, CITY_MEASUREMENT, TOTAL, city), as_of, tz).orderBy("time")


def country_series_today(points: DataFrame, as_of: datetime | str, tz: str = DASHBOARD_TZ) -> DataFrame:
    """Today's totals of the country, in time order."""
    return since_local_midnight(select_series(points, COUNTRY_MEASUREMENT), as_of, tz).orderBy("time")


def city_hourly_bars(
    points: DataFrame,
    as_of: datetime | str,
    city: str | None = None,
    tz: str = DASHBOARD_TZ,
    fill: bool = True,
) -> DataFrame:
    """Today's hourly sums of one city, or of each city."""
    return hourly_bars(select_series(points, CITY_MEASUREMENT, TOTAL, city), as_of, tz, fill)


def country_hourly_bars(
    points: DataFrame, as_of: datetime | str, tz: str = DASHBOARD_TZ, fill: bool = True
) -> DataFrame:
    """Today's hourly sums of the country."""
    return hourly_bars(select_series(points, COUNTRY_MEASUREMENT), as_of, tz, fill)
