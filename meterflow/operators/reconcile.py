"""From repeated partial results to one final value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.clock import calendar_parts, duration
from meterflow.schemas import HOURLY_STORE, TOTAL

HOURLY_KEYS = ("meterID", "unix_window", "cityID")


def _newest(value: str | Column, order_by: str | Sequence[str]) -> Column:
    order = F.col(order_by) if isinstance(order_by, str) else F.struct(*order_by)
    return F.max_by(value, order)


def reconcile(
    partials: DataFrame,
    keys: Sequence[str] = HOURLY_KEYS,
    how: str = "max",
    *,
    value: str = TOTAL,
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """One row per key from the results a stream emitted in update mode.

    ``max`` keeps the largest value, which is the final one while all deltas are
    non-negative. ``latest`` keeps the value with the highest ``order_by`` (an offset, or
    batch columns) and is right for signed deltas too.
    """
    if how == "max":
        final = F.max(value)
    elif how == "latest":
        if order_by is None:
            raise ValueError("how='latest' needs order_by")
        final = _newest(value, order_by)
    else:
        raise ValueError(f"how must be 'max' or 'latest', not {how!r}")
    return partials.groupBy(*keys).agg(final.alias(value))


def build_hourly_store(
    partials: DataFrame,
    tz: str = "UTC",
    how: str = "max",
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Final hourly values in the layout of the hourly store."""
    final = reconcile(partials, HOURLY_KEYS, how, order_by=order_by)
    dated = final.withColumn("date", F.timestamp_seconds("unix_window.start"))
    return calendar_parts(dated, "date", tz).select(*HOURLY_STORE.fieldNames())


def compact_latest(
    messages: DataFrame, key: str | Sequence[str] = "key", order_by: str | Sequence[str] = "offset"
) -> DataFrame:
    """The newest ``value`` of every key, as a compacted topic holds it.

    Messages without a key cannot be compacted, and a newest value that is null deletes
    its key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    keyed = messages.dropna(subset=keys)
    return keyed.groupBy(*keys).agg(_newest("value", order_by).alias("value")).where("value IS NOT NULL")


def diff_aggregates(
    actual: DataFrame,
    expected: DataFrame,
    keys: Sequence[str],
    scale: int = 5,
    *,
    value: str = TOTAL,
) -> DataFrame:
    """Keys whose values differ between two aggregate tables, or that only one of them has.

    Values are rounded half-up to ``scale`` digits first, and the larger one counts where a
    key is repeated. Both sides go through one grouping instead of a join, so a repeated
    key never multiplies rows.
    """
    def side(df: DataFrame, mark: bool) -> DataFrame:
        return df.select(*keys, F.round(value, scale).alias("_value"), F.lit(mark).alias("_actual"))

    is_actual = F.col("_actual")
    both = side(actual, True).unionByName(side(expected, False))
    compared = both.groupBy(*keys).agg(
        F.max(F.when(is_actual, F.col("_value"))).alias("actual"),
        F.max(F.when(~is_actual, F.col("_value"))).alias("expected"),
        F.bool_or(is_actual).alias("_in_actual"),
        F.bool_or(~is_actual).alias("_in_expected"),
    )
    return _differences(compared).select(*keys, "actual", "expected", "status")


def _differences(compared: DataFrame) -> DataFrame:
    status = (
        F.when(~F.col("_in_expected"), "unexpected")
        .when(~F.col("_in_actual"), "missing")
        .when(~F.col("actual").eqNullSafe(F.col("expected")), "different")
    )
    return compared.withColumn("status", status).where("status IS NOT NULL")


def diff_streams(
    actual: DataFrame,
    expected: DataFrame,
    keys: Sequence[str],
    time: str,
    watermark: int | str = "0 seconds",
    scale: int = 5,
    *,
    value: str = TOTAL,
) -> DataFrame:
    """:func:`diff_aggregates` of two streams, as their results arrive.

    ``time`` is an event time that belongs to the keys, as the end of a window. Each side brings a key once, as
    an aggregate in append mode does. Keys that both sides have are compared when the second one
    comes; a key that only one side has comes out once the watermark of both streams has passed
    its time, and so does its state. The stream with the older times holds the other one's state back. Keys
    without a time are compared with nothing. Rows with a time but no other keys may be sent on both sides as
    a clock's ticks, so that the last keys come out too.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        marked = df.withWatermark(time, duration(watermark))
        named = [F.col(k).alias(f"_{name}_{k}") for k in (*keys, time)]
        return marked.select(*named, F.round(value, scale).alias(name), F.lit(True).alias(f"_in_{name}"))

    same = F.col(f"_actual_{time}") == F.col(f"_expected_{time}")
    for key in keys:
        same &= F.col(f"_actual_{key}").eqNullSafe(F.col(f"_expected_{key}"))
    both = side(actual, "actual").join(side(expected, "expected"), same, "fullouter")
    compared = both.select(
        *[F.coalesce(f"_actual_{k}", f"_expected_{k}").alias(k) for k in (*keys, time)],
        "actual",
        "expected",
        *[F.coalesce(f"_in_{name}", F.lit(False)).alias(f"_in_{name}") for name in ("actual", "expected")],
    )
    return _differences(compared).select(*keys, time, "actual", "expected", "status")
