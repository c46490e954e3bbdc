from helpers import readings, epoch, rows

from meterflow import operators as op


def history(spark, data):
    """(meterID, date text, value)"""
    df = spark.createDataFrame(data, "meterID long, date string, aggregatedActiveDelta double").selectExpr(
        "meterID", "cast(date AS timestamp) AS date", "aggregatedActiveDelta"
    )
    from meterflow.functions import calendar_parts

    return calendar_parts(df, "date")


YEARS = [
    (1, "2022-01-01 00:00:00", 4.0), (1, "2022-07-01 10:00:00", 6.0), (2, "2022-02-01 10:00:00", 2.0),
    (3, "2022-09-05 23:00:00", 6.0), (1, "2021-01-01 00:00:00", 100.0), (2, "2021-12-31 10:00:00", 100.0),
]


def test_above_average_of_one_year(spark):
    """Totals 10, 2 and 6 average 6; a total equal to the average counts."""
    got = op.above_average_consumers(history(spark, YEARS), 2022)
    assert got.columns == ["meterID", "totalConsumptionInYear", "averageYearlyConsumption"]
    assert rows(got) == [(1, 10.0, 6.0), (3, 6.0, 6.0)]


def test_above_average_of_every_year(spark):
    assert rows(op.above_average_consumers(history(spark, YEARS))) == [
        (2021, 1, 100.0, 100.0), (2021, 2, 100.0, 100.0), (2022, 1, 10.0, 6.0), (2022, 3, 6.0, 6.0),
    ]


def test_a_year_without_data(spark):
    assert rows(op.above_average_consumers(history(spark, YEARS), 1999)) == []


def test_history_is_shuffled_once_for_total_and_average(spark):
    df = op.above_average_consumers(history(spark, YEARS), 2022)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_top_consumers(spark):
    hist = history(spark, YEARS)
    overall = op.top_consumers(hist, 3)
    assert [tuple(r) for r in overall.collect()] == [(2021, 1, 100.0), (2021, 2, 100.0), (2022, 1, 10.0)]
    assert rows(op.top_consumers(hist, 1, per_year=True)) == [(2021, 1, 100.0, 1), (2022, 1, 10.0, 1)]
    assert rows(op.top_consumers(hist, 1, year=2022)) == [(2022, 1, 10.0)]
    plan = op.top_consumers(hist, 1, per_year=True)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_season_hour_profile(spark):
    got = op.season_hour_profile(history(spark, YEARS + [(4, "2022-06-01 10:00:00", 3.0)]))
    assert got.columns == ["hour", "Winter", "Spring", "Summer", "Fall"]
    assert [tuple(r) for r in got.collect()] == [
        (0, 52.0, None, None, None), (10, 2.0, 3.0, 6.0, 100.0), (23, None, None, None, 6.0),
    ]


def test_daily_average(spark):
    assert rows(op.daily_average(history(spark, YEARS))) == [(1, 28.0), (31, 100.0), (5, 6.0)]


def test_daily_by_meter_uses_the_local_day(spark):
    """One reading a minute for a day, as seen from two zones."""
    start = epoch("2024-01-01 00:00:00")
    df = readings(spark, [(1, 1, start + 60 * i, 0.5) for i in range(1440)])
    assert rows(op.daily_by_meter(df)) == [(1, 1, "2024-01-01", 720.0)]
    assert rows(op.daily_by_meter(df, "Europe/Sarajevo")) == [(1, 1, "2024-01-01", 690.0), (1, 1, "2024-01-02", 30.0)]


def test_daypart_profile(spark):
    assert rows(op.daypart_profile(history(spark, YEARS))) == sorted([
        ("Winter", "night", 104.0, 52.0, 2), ("Winter", "working", 2.0, 2.0, 1), ("Summer", "working", 6.0, 6.0, 1),
        ("Summer", "evening", 6.0, 6.0, 1), ("Fall", "working", 100.0, 100.0, 1),
    ], key=repr)
