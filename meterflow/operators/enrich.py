"""Joins with small tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key in one micro-batch from which on it is spread over several tasks.
HOT_ROWS = 100_000


def enrich_city(df: DataFrame, cities: DataFrame, how: str = "inner") -> DataFrame:
    """Attach the city columns by ``cityID``.

    ``inner`` drops rows of unknown cities, ``left`` keeps them. Used after aggregation,
    so one row per city and window is joined. There is no hint: Spark broadcasts the
    table while its size is below ``spark.sql.autoBroadcastJoinThreshold``, and shuffles
    both sides above it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    return df.join(cities, "cityID", how)


def _broadcast_by_spark(df: DataFrame) -> bool:
    """Whether Spark's own size estimate of ``df`` is within its broadcast threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= threshold


def hot_keys(df: DataFrame, key: str, part: Column, least: int = HOT_ROWS) -> list:
    """The keys that have ``least`` rows or more in one ``part`` of a batch table, to be told to :func:`lookup_join`.

    A key must also have a thousandth of all rows in the part, so that there are at most a thousand of them.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(part.alias("_part"), key).agg(F.count("*").alias("_rows"))
    found = counts.where(F.col("_rows") >= least).groupBy(key).agg(F.max("_rows").alias("_rows"))
    rows = found.orderBy(F.col("_rows").desc(), key).limit(1000).collect()
    least_share = df.count() / 1000 if rows else 0
    return sorted(r[0] for r in rows if r[1] >= least_share)


def lookup_join(
    df: DataFrame, dim: DataFrame, key: str, *, salts: int = 32, hot: Callable[[], Sequence] | None = None
) -> DataFrame:
    """Join rows that are skewed on ``key`` with a table that has one row per key.

    Spark broadcasts a table within ``spark.sql.autoBroadcastJoinThreshold``. Beyond that a
    batch is left to the adaptive skew join, which splits a hot key by what it finds at run
    time. A stream has no such help: there both sides are shuffled by the key and a salt, and
    the keys that ``hot`` names (only then asked, see :func:`hot_keys`) are spread over ``salts`` tasks, with a copy of
    their rows of the table per salt in every micro-batch. Where nothing is known of the keys (None) all are
    treated so, and the whole table is copied. All ways give the same rows; which one a stream takes is settled by
    Spark's size estimate when it is started.
    """
    if not df.isStreaming or _broadcast_by_spark(dim):
        return df.join(dim, key)
    others = [name for name in df.columns if name != key]
    salt = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        keys = list(hot())
        if not keys:
            return df.join(dim, key)
        salt = F.when(F.col(key).isin(keys), salt).otherwise(0)
        every = F.when(F.col(key).isin(keys), every).otherwise(F.array(F.lit(0)))
    salted = df.withColumn("_salt", salt)
    copies = dim.withColumn("_salt", F.explode(every))
    return salted.join(copies, [key, "_salt"]).drop("_salt")
