"""Readings that look wrong."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.bands import PROFILE_BANDS, daypart, season, season_factor
from meterflow.functions.clock import calendar_parts
from meterflow.operators.stateful import rollback_stream
from meterflow.schemas import BAND


def detect_rollback(
    readings: DataFrame,
    register: str | None = None,
    order_by: Sequence[str] = ("timestamp",),
    span: int = 86_400,
) -> DataFrame:
    """Reports that go backwards.

    Without ``register``: negative deltas, row by row, also on a stream. With ``register``:
    reports whose cumulative reading is below the one before it of the same
    meter, which comes along as ``previous``; a stream keeps the last report of each meter
    (:func:`~meterflow.operators.stateful.rollback_stream`). ``order_by`` begins with the time and should have
    no ties within a meter. Reports without a reading or a time have no place in the order
    and are left out.

    One meter may hold a large part of all reports, so a meter is not a group here: reports
    are compared within a meter's stretch of ``span`` seconds. The first report of a stretch is
    compared with the last one of the stretch before; for that each stretch is one row, first
    and last, combined before it is shuffled. Nothing is written.
    """
    if register is None:
        return readings.where(F.col("activeDelta") < 0)
    if readings.isStreaming:
        return rollback_stream(readings, register, order_by)
    order = F.struct(*order_by)
    reports = readings.dropna(subset=[register, "meterID", *order_by]).withColumn(
        "_stretch", F.floor(F.unix_seconds(order_by[0]) / span)
    )
    stretch = Window.partitionBy("meterID", "_stretch").orderBy(*order_by)
    inside = reports.withColumn("previous", F.lag(register).over(stretch))
    ends = reports.groupBy("meterID", "_stretch").agg(
        F.min_by(F.struct(*readings.columns), order).alias("_first"),
        F.max_by(F.col(register), order).alias("_last"),
    )
    begun = ends.withColumn("previous", F.lag("_last").over(Window.partitionBy("meterID").orderBy("_stretch")))
    columns = [*readings.columns, "previous"]
    both = inside.select(*columns).unionByName(begun.select("_first.*", "previous").select(*columns))
    return both.where(F.col(register) < F.col("previous"))


def hourly_bounds(bands: DataFrame) -> DataFrame:
    """Band table by hour: at most 24 rows; where bands overlap the earliest one counts."""
    return (
        bands.select(F.explode(F.sequence("from_hour", "to_hour")).alias("hour"), "*")
        .where(F.col("hour").between(0, 23))
        .groupBy("hour")
        .agg(F.min(F.struct("from_hour", "to_hour", "min_delta", "max_delta")).alias("band"))
        .select("hour", "band.min_delta", "band.max_delta")
    )


def out_of_profile(
    readings: DataFrame,
    bands: DataFrame | Sequence[tuple[int, int, float, float]] = PROFILE_BANDS,
    factors: dict[str, float] | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """Readings outside the expected range of their hour, scaled by their season."""
    if not isinstance(bands, DataFrame):
        bands = readings.sparkSession.createDataFrame(list(bands), BAND)
    dated = calendar_parts(readings, "timestamp", tz, ["hour", "month"])
    factor = season_factor("month", factors)
    return (
        dated.join(F.broadcast(hourly_bounds(bands)), "hour")
        .withColumns({"lower": F.col("min_delta") * factor, "upper": F.col("max_delta") * factor})
        .where((F.col("activeDelta") < F.col("lower")) | (F.col("activeDelta") > F.col("upper")))
        .select(*readings.columns, "lower", "upper")
    )


#: Size of a sketch. With it a learnt bound's rank is wrong by 0.1 % at most (at 99 % confidence); up to so many readings of a month
#: and part of the day it is exact.
SKETCH_K = 4096


def month_profiles(readings: DataFrame, tz: str = "UTC", k: int = SKETCH_K) -> DataFrame:
    """(year, month, daypart, sketch): the distribution of one month's deltas in each part of the day.

    A row is some tens of kilobytes however many readings it stands for, and sketches are combined before
    they are shuffled. Keep the rows of closed months: :func:`learn_bounds` merges them, so history is not
    read again to learn from it. Readings without a time or value are left out.
    """
    dated = calendar_parts(readings.dropna(subset=["timestamp", "activeDelta"]), "timestamp", tz, ["year", "month", "hour"])
    return dated.groupBy("year", "month", daypart("hour").alias("daypart")).agg(
        F.kll_sketch_agg_double("activeDelta", k).alias("sketch")
    )


def learn_bounds(profiles: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """(season, daypart, lower, upper): the deltas between which readings usually lie, from the profiles of any months.

    At most four seasons (of quarters) by four parts of the day.
    """
    merged = profiles.groupBy(season("month", "quarter").alias("season"), "daypart").agg(
        F.kll_merge_agg_double("sketch").alias("sketch")
    )
    return merged.select(
        "season",
        "daypart",
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(low))).alias("lower"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(high))).alias("upper"),
    )


def out_of_learnt_profile(readings: DataFrame, bounds: DataFrame, tz: str = "UTC") -> DataFrame:
    """Readings outside the bounds of their season and part of the day, which come along; those without bounds are not judged."""
    dated = calendar_parts(readings, "timestamp", tz, ["hour", "month"])
    keyed = dated.withColumns({"season": season("month", "quarter"), "daypart": daypart("hour")})
    return (
        keyed.join(F.broadcast(bounds), ["season", "daypart"])
        .where((F.col("activeDelta") < F.col("lower")) | (F.col("activeDelta") > F.col("upper")))
        .select(*readings.columns, "lower", "upper")
    )
