import pytest
from helpers import READINGS, cities, epoch, readings, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterflow import operators as op
from meterflow.session import register


def flat(df):
    return rows(op.flat_window(df).select(
        *[c for c in df.columns if c not in ("unix_window", "aggregatedActiveDelta")],
        "window_start", "window_end", "aggregatedActiveDelta",
    ))


def test_total_consumption(spark):
    assert flat(op.total_consumption(readings(spark))) == sorted([(99, 102, 3.5), (120, 123, 1.0)], key=repr)


def test_unknown_city_disappears_or_stays(spark):
    inner = op.total_by_city(readings(spark), cities(spark)).select("cityID", "cityName", "aggregatedActiveDelta")
    assert rows(inner) == [(1, "A", 1.0), (1, "A", 1.5)]
    left = op.total_by_city(readings(spark), cities(spark), how="left").select("cityID", "cityName")
    assert (9, None) in rows(left)
    with pytest.raises(ValueError):
        op.enrich_city(readings(spark), cities(spark), "outer")


def test_hourly_by_meter_separates_cities_and_edges(spark):
    data = [(1, 1, 3599, 1.0), (1, 1, 3600, 2.0), (1, 2, 3601, 4.0), (1, 1, 7199, 8.0), (1, 1, None, 16.0)]
    assert flat(op.hourly_by_meter(readings(spark, data))) == sorted([
        (1, 1, 0, 3600, 1.0),
        (1, 1, 3600, 7200, 10.0),
        (1, 2, 3600, 7200, 4.0),
    ], key=repr)


def test_windows_are_aligned_to_the_epoch(spark):
    data = [(1, 1, epoch("2024-01-01 00:00:00"), 1.0)]
    (start, end, _), = flat(op.windowed_sum(readings(spark, data), [], 7))
    assert start % 7 == 0 and end == start + 7
    (start, end, _), = flat(op.windowed_sum(readings(spark, data), [], "1 hour", start_time="30 minutes"))
    assert (start, end) == (epoch("2023-12-31 23:30:00"), epoch("2024-01-01 00:30:00"))


@pytest.mark.parametrize("window,start_time", [(7, None), (3, 2), ("1 hour", "-10 minutes"), ("90 minutes", "80 minutes")])
def test_batch_windows_equal_the_window_function(spark, window, start_time):
    """Also before 1970 and with fractions of a second."""
    df = spark.range(-4000, 4000).select(
        F.timestamp_micros(F.col("id") * 1_234_567_891).alias("timestamp"), F.lit(1.0).alias("activeDelta")
    )
    shift = f"{start_time} seconds" if isinstance(start_time, int) else start_time
    text = f"{window} seconds" if isinstance(window, int) else window
    w = F.window("timestamp", text, startTime=shift)
    expected = df.groupBy(w.alias("w")).agg(F.sum("activeDelta")).select(
        F.unix_timestamp("w.start"), F.unix_timestamp("w.end"), "sum(activeDelta)"
    )
    assert flat(op.windowed_sum(df, [], window, start_time=start_time)) == rows(expected)


def test_nulls_in_the_value_do_not_count(spark):
    data = [(1, 1, 0, None), (1, 1, 1, 2.0), (2, 1, 0, None)]
    assert flat(op.windowed_sum(readings(spark, data), ["meterID"], 3)) == [(1, 0, 3, 2.0), (2, 0, 3, None)]


def test_sql_text_gives_the_same(spark):
    register(readings(spark), "some_readings")
    by_sql = op.windowed_sum_sql(spark, "some_readings", ["meterID"], 3)
    assert flat(by_sql) == flat(op.windowed_sum(readings(spark), ["meterID"], 3))


def test_three_rounds_of_fifty_readings(spark):
    """Three rounds of fifty readings, three seconds apart, against a plain sum."""
    start = epoch("2022-08-10 11:59:57")
    data = [(i % 5, i % 14, start + 3 * j, 0.25 + i / 64) for j in range(3) for i in range(50)]
    city, country, hourly = {}, {}, {}
    for meter, city_id, second, delta in data:
        window = second // 3 * 3
        hour = second // 3600 * 3600
        city[city_id, window] = city.get((city_id, window), 0) + delta
        country[window] = country.get(window, 0) + delta
        hourly[meter, city_id, hour] = hourly.get((meter, city_id, hour), 0) + delta
    df = readings(spark, data)
    by_city = op.windowed_sum(df, ["cityID"], 3)
    assert flat(by_city) == sorted([(c, w, w + 3, v) for (c, w), v in city.items()], key=repr)
    assert flat(op.total_consumption(df)) == sorted([(w, w + 3, v) for w, v in country.items()], key=repr)
    assert flat(op.hourly_by_meter(df)) == sorted([(m, c, h, h + 3600, v) for (m, c, h), v in hourly.items()], key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    deltas=st.lists(st.tuples(st.integers(1, 3), st.integers(0, 7200), st.integers(0, 400)), min_size=1, max_size=30),
    cuts=st.lists(st.integers(0, 30), max_size=4),
)
def test_reconciled_partials_equal_the_direct_sum(spark, deltas, cuts):
    """Whatever batches the readings came in."""
    data = [(m, 1, t, v / 4) for m, t, v in deltas]
    direct = op.hourly_by_meter(readings(spark, data))
    ends = sorted({min(c, len(data)) for c in cuts if c} | {len(data)})
    emitted = None
    for end in ends:
        part = op.hourly_by_meter(readings(spark, data[:end]))
        emitted = part if emitted is None else emitted.unionByName(part)
    assert flat(op.reconcile(emitted).select(*direct.columns)) == flat(direct)


def test_sums_combine_before_the_shuffle(spark):
    plan = op.total_consumption(readings(spark, READINGS))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert plan.count("Exchange hashpartitioning") == 1
