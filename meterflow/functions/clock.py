"""Instants, wall clocks and window bounds.

Everything here is independent of the session time zone. An instant is turned into the
seconds that a clock in an explicitly named zone has counted, and calendar parts are taken
from that number, not from a timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def duration(value: int | str | timedelta) -> str:
    """A duration argument: whole seconds, a timedelta, or Spark's own text."""
    if isinstance(value, timedelta):
        value = int(value.total_seconds())
    return f"{value} seconds" if isinstance(value, int) else value


def interval_micros(value: int | str | timedelta) -> Column:
    """The length of a duration argument in microseconds, as a constant."""
    interval = F.expr(f"CAST(INTERVAL '{duration(value)}' AS INTERVAL DAY TO SECOND)")
    parts = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    seconds = sum(F.extract(F.lit(part), interval) * factor for part, factor in parts.items())
    return (seconds * 1_000_000).cast("long")


def epoch_to_timestamp(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Replace epoch seconds by the instant they name."""
    return df.withColumn(col, F.timestamp_seconds(col))


def _local_seconds(ts: Column | str, tz: str) -> Column:
    return F.unix_seconds(ts if tz == "UTC" else F.from_utc_timestamp(ts, tz))


def local_date(ts: Column | str, tz: str = "UTC") -> Column:
    """The day that a calendar in ``tz`` shows at the instant ``ts``."""
    return F.date_from_unix_date(F.floor(_local_seconds(ts, tz) / 86400).cast("int"))


def local_hour(ts: Column | str, tz: str = "UTC") -> Column:
    """The hour that a clock in ``tz`` shows at the instant ``ts``."""
    return F.floor(F.pmod(_local_seconds(ts, tz), F.lit(86400)) / 3600).cast("int")


_PARTS = {
    "year": lambda ts, tz: F.year(local_date(ts, tz)),
    "month": lambda ts, tz: F.month(local_date(ts, tz)),
    "day": lambda ts, tz: F.dayofmonth(local_date(ts, tz)),
    "hour": local_hour,
}


def calendar_parts(
    df: DataFrame, ts: str = "date", tz: str = "UTC", parts: Sequence[str] = ("year", "month", "hour")
) -> DataFrame:
    """Add the named calendar columns (year, month, day, hour) of ``ts`` in ``tz``."""
    return df.withColumns({part: _PARTS[part](ts, tz) for part in parts})


def unix_window(window: Column | str = "window") -> Column:
    """A window struct as a struct of epoch seconds."""
    window = F.col(window) if isinstance(window, str) else window
    return F.struct(
        F.unix_timestamp(window["start"]).alias("start"),
        F.unix_timestamp(window["end"]).alias("end"),
    )


def time_shift(df: DataFrame, col: str, by: int | str | timedelta) -> DataFrame:
    """Move ``col`` by a constant, for example ``"-1 hour"``."""
    return df.withColumn(col, F.col(col) + F.expr(f"INTERVAL '{duration(by)}'"))


def as_instant(value: datetime | str) -> datetime:
    """An aware datetime; text and naive values are read as UTC."""
    value = datetime.fromisoformat(value) if isinstance(value, str) else value
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def local_midnight(as_of: datetime | str, tz: str) -> datetime:
    """The instant at which the day of ``as_of`` began in ``tz``."""
    local = as_instant(as_of).astimezone(ZoneInfo(tz))
    return local.replace(hour=0, minute=0, second=0, microsecond=0).astimezone(timezone.utc)
