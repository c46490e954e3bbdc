"""Literal rows for the tests."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

READINGS = [(1, 1, 100, 1.0), (1, 1, 101, 0.5), (2, 9, 101, 2.0), (1, 1, 120, 1.0)]
CITIES = [(1, 44.8, 17.2, "A"), (2, 43.8, 18.4, "B")]


def readings(spark, rows=READINGS):
    df = spark.createDataFrame(rows, "meterID long, cityID long, timestamp long, activeDelta double")
    return df.withColumn("timestamp", F.timestamp_seconds("timestamp"))


def cities(spark):
    return spark.createDataFrame(CITIES, "cityID long, latitude double, longitude double, cityName string")


def partials(spark, rows):
    """(meterID, cityID, window start, value) with one-hour windows."""
    return spark.createDataFrame(rows, "meterID long, cityID long, start long, aggregatedActiveDelta double").select(
        "meterID",
        "cityID",
        F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + 3600).alias("end"))).alias(
            "unix_window"
        ),
        "aggregatedActiveDelta",
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def epoch(text):
    return int(utc(text).timestamp())
