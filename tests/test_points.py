from datetime import timedelta

import pytest
from helpers import cities, epoch, readings, rows, utc
from pyspark.sql import functions as F

from meterflow import operators as op
from meterflow.functions import local_midnight
from meterflow.operators.points import CITY_MEASUREMENT, COUNTRY_MEASUREMENT


def points(spark, data):
    """(measurement, city name or None, field, time text, value)"""
    df = spark.createDataFrame(data, "measurement string, city string, field string, time string, value double")
    tags = F.when(F.col("city").isNull(), F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(F.lit("cityID"), F.lit("1"), F.lit("cityName"), "city")
    )
    return df.select("measurement", tags.alias("tags"), "field", F.col("time").cast("timestamp").alias("time"), "value")


def city(time, value, name="A", field="aggregatedActiveDelta"):
    return (CITY_MEASUREMENT, name, field, time, value)


def bars(df):
    return rows(df.select(F.unix_timestamp("time"), "value"))


def test_city_points(spark):
    totals = op.total_by_city(readings(spark), cities(spark), how="left").where("cityID = 1 OR cityID = 9")
    got = {(r.tags["cityID"], r.time.second): r for r in op.to_city_points(totals).collect()}
    assert got["1", 42].measurement == "city-aggregation"
    assert got["1", 42].tags == {"cityID": "1", "cityName": "A"}
    assert got["1", 42].fields == {"aggregatedActiveDelta": 1.5, "latitude": 44.8, "longitude": 17.2}
    assert got["9", 42].tags == {"cityID": "9"}
    assert got["9", 42].fields == {"aggregatedActiveDelta": 2.0}
    starts = op.to_city_points(totals, time="start").select(F.unix_timestamp("time")).distinct()
    assert rows(starts) == sorted([(99,), (120,)], key=repr)
    with pytest.raises(ValueError):
        op.to_city_points(totals, time="middle")


def test_country_points(spark):
    made = op.to_country_points(op.total_consumption(readings(spark)))
    assert sorted((r.measurement, r.tags, r.fields["aggregatedActiveDelta"]) for r in made.collect()) == [
        ("country-aggregation", {}, 1.0), ("country-aggregation", {}, 3.5)
    ]
    assert rows(op.unpivot_fields(made).select("field", F.unix_timestamp("time"), "value")) == [
        ("aggregatedActiveDelta", 102, 3.5), ("aggregatedActiveDelta", 123, 1.0)
    ]


def test_select_series(spark):
    df = points(spark, [
        city("2024-01-01 00:00:00", 1.0), city("2024-01-01 00:00:00", 2.0, "B"),
        city("2024-01-01 00:00:00", 3.0, field="latitude"),
        (COUNTRY_MEASUREMENT, None, "aggregatedActiveDelta", "2024-01-01 00:00:00", 4.0),
    ])
    assert op.select_series(df, CITY_MEASUREMENT).count() == 3
    assert rows(op.select_series(df, CITY_MEASUREMENT, "aggregatedActiveDelta", "B").select("value")) == [(2.0,)]
    assert rows(op.select_series(df, COUNTRY_MEASUREMENT).select("value")) == [(4.0,)]


def test_ranges_are_half_open(spark):
    times = ["2024-06-30 21:59:59", "2024-06-30 22:00:00", "2024-07-01 09:59:20", "2024-07-01 09:59:59", "2024-07-01 10:00:00"]
    df = points(spark, [city(t, float(i)) for i, t in enumerate(times)])
    assert rows(op.since_local_midnight(df, "2024-07-01T10:00:00").select("value")) == [(1.0,), (2.0,), (3.0,)]
    assert rows(op.recent(df, utc("2024-07-01 10:00:00")).select("value")) == [(2.0,), (3.0,)]
    assert rows(op.recent(df, "2024-07-01T12:00:00+02:00", 30).select("value")) == [(3.0,)]


def test_hourly_bars_fill_empty_hours(spark):
    df = points(spark, [
        city("2023-12-31 23:00:00", 1.0), city("2023-12-31 23:59:57", 2.0), city("2024-01-01 00:00:00", 4.0),
        city("2024-01-01 02:10:00", 8.0), city("2023-12-31 22:59:59", 99.0), city("2024-01-01 02:30:00", 99.0),
    ])
    filled = op.city_hourly_bars(df, "2024-01-01T02:30:00", "A")
    hour = epoch("2023-12-31 23:00:00")
    assert bars(filled) == [(hour, 3.0), (hour + 3600, 4.0), (hour + 7200, None), (hour + 10800, 8.0)]
    assert bars(op.city_hourly_bars(df, "2024-01-01T02:30:00", "A", fill=False)) == [
        (hour, 3.0), (hour + 3600, 4.0), (hour + 10800, 8.0)
    ]


def test_hourly_bars_of_a_series_without_points_today(spark):
    df = points(spark, [city("2024-01-01 10:00:00", 1.0), city("2023-12-01 10:00:00", 1.0, "B")])
    got = op.city_hourly_bars(df, "2024-01-01T11:00:00")
    assert {r.city for r in got.select(F.col("tags")["cityName"].alias("city")).collect()} == {"A"}


def test_hourly_bars_exactly_at_midnight(spark):
    df = points(spark, [city("2023-12-31 23:00:00", 1.0)])
    assert bars(op.city_hourly_bars(df, local_midnight("2024-01-01T10:00:00", "Europe/Sarajevo"))) == []


@pytest.mark.parametrize("day,hours", [("2024-03-31", 23), ("2024-10-27", 25), ("2024-05-05", 24)])
def test_hourly_bars_on_days_of_a_clock_change(spark, day, hours):
    midnight = local_midnight(f"{day}T12:00:00", "Europe/Sarajevo")
    end = midnight + timedelta(hours=hours, seconds=-1)
    df = points(spark, [(COUNTRY_MEASUREMENT, None, "aggregatedActiveDelta", f"{midnight:%F %T}", 1.0)])
    got = bars(op.country_hourly_bars(df, end))
    first = int(midnight.timestamp())
    assert got == [(first, 1.0)] + [(first + 3600 * i, None) for i in range(1, hours)]
    assert local_midnight(end, "Europe/Sarajevo") == midnight != local_midnight(end + timedelta(seconds=1), "Europe/Sarajevo")


def test_hourly_bars_in_a_half_hour_zone(spark):
    df = points(spark, [city("2024-01-01 18:40:00", 1.0), city("2024-01-01 19:29:59", 2.0), city("2024-01-01 19:30:00", 4.0)])
    start = epoch("2024-01-01 18:30:00")
    assert bars(op.city_hourly_bars(df, "2024-01-01T20:00:00", tz="Asia/Kolkata")) == [(start, 3.0), (start + 3600, 4.0)]


def test_last_per_series(spark):
    df = points(spark, [city("2024-01-01 00:00:00", 5.0), city("2024-01-01 00:00:03", 1.0), city("2024-01-01 00:00:00", 2.0, "B")])
    assert rows(op.last_per_series(df).select(F.col("tags")["cityName"], "value")) == [("A", 1.0), ("B", 2.0)]


def test_tags_in_another_order_are_the_same_series(spark):
    one = points(spark, [city("2024-01-01 00:00:00", 5.0)])
    turned = points(spark, [city("2024-01-01 00:00:03", 6.0)]).withColumn(
        "tags", F.map_from_entries(F.reverse(F.map_entries("tags")))
    )
    assert rows(op.last_per_series(one.unionByName(turned)).select("value")) == [(6.0,)]


def test_city_map_latest(spark):
    data = [
        city(t, v, n, f)
        for n, t, base in (("A", "2024-01-01 00:00:27", 1.0), ("A", "2024-01-01 00:00:30", 2.0), ("B", "2024-01-01 00:00:24", 3.0), ("C", "2023-12-31 23:59:00", 9.0))
        for f, v in (("aggregatedActiveDelta", base), ("latitude", 40 + base), ("longitude", 10 + base))
    ]
    got = op.city_map_latest(points(spark, data), "2024-01-01T00:00:40")
    assert got.columns == ["time", "aggregatedActiveDelta", "latitude", "longitude", "cityID", "cityName"]
    assert rows(got.select("cityName", "aggregatedActiveDelta", "latitude", "longitude")) == [("A", 2.0, 42.0, 12.0), ("B", 3.0, 43.0, 13.0)]


def test_series_of_today_are_in_time_order(spark):
    df = points(spark, [city("2024-01-01 10:00:03", 1.0), city("2024-01-01 10:00:00", 2.0), city("2024-01-01 10:00:01", 3.0, "B"),
                        (COUNTRY_MEASUREMENT, None, "aggregatedActiveDelta", "2024-01-01 09:00:00", 4.0)])
    assert [r.value for r in op.city_series_today(df, "A", "2024-01-01T12:00:00").collect()] == [2.0, 1.0]
    assert [r.value for r in op.country_series_today(df, "2024-01-01T12:00:00").collect()] == [4.0]
