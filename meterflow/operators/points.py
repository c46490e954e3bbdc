"""Time-series points: a measurement, tags, numeric fields and a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.schemas import TOTAL

# Names of the two measurements.
CITY_MEASUREMENT = "city-aggregation"
COUNTRY_MEASUREMENT = "country-aggregation"

CITY_FIELDS = (TOTAL, "latitude", "longitude")


def _present(**entries: Column) -> Column:
    """A map of the entries; like a point, it has no entry for a null."""
    pairs = [part for name, value in entries.items() for part in (F.lit(name), value)]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def _window_time(time: str) -> Column:
    if time not in ("start", "end"):
        raise ValueError(f"time must be 'start' or 'end', not {time!r}")
    return F.timestamp_seconds(F.col(f"unix_window.{time}")).alias("time")


def to_city_points(totals: DataFrame, time: str = "end") -> DataFrame:
    """City totals as points, stamped with one bound of their window."""
    return totals.select(
        F.lit(CITY_MEASUREMENT).alias("measurement"),
        _present(cityID=F.col("cityID").cast("string"), cityName=F.col("cityName")).alias("tags"),
        _present(**{name: F.col(name) for name in CITY_FIELDS}).alias("fields"),
        _window_time(time),
    )


def to_country_points(totals: DataFrame, time: str = "end") -> DataFrame:
    """Country totals as points; they have one field and no tags."""
    return totals.select(
        F.lit(COUNTRY_MEASUREMENT).alias("measurement"),
        F.create_map().cast("map<string,string>").alias("tags"),
        _present(**{TOTAL: F.col(TOTAL)}).alias("fields"),
        _window_time(time),
    )


def unpivot_fields(points: DataFrame) -> DataFrame:
    """One row per series, field and time."""
    # The outer form and a filter: for a plain explode the optimizer would build the map a
    # second time, to test its size below the join that made it.
    return points.select("measurement", "tags", "time", F.explode_outer("fields").alias("field", "value")).where(
        "value IS NOT NULL"
    )
