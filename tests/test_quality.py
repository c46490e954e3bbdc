import random
from contextlib import contextmanager
from pathlib import Path

from helpers import epoch, partials, readings, rows
from pyspark.sql import functions as F

from meterflow import operators as op
from meterflow.operators.enrich import lookup_join
from meterflow.operators.quality import hourly_bounds
from meterflow.schemas import BAND
from meterflow.shared import shared_dir


def test_negative_deltas(spark):
    data = [(1, 1, 0, -0.1), (1, 1, 1, 0.0), (1, 1, 2, None), (1, 1, 3, 2.0)]
    assert rows(op.detect_rollback(readings(spark, data)).select("activeDelta")) == [(-0.1,)]


def test_rollback_equals_brute_force_with_one_hot_meter(spark):
    """A third of the reports belong to one meter, many at the same instant."""
    rnd = random.Random(5)
    data = [
        (i, 1 if i % 3 == 0 else rnd.randint(2, 40), rnd.randint(0, 50) * 60, rnd.choice([None, *range(20)]))
        for i in range(6000)
    ]
    df = spark.createDataFrame(data, "id long, meterID long, s long, total int").withColumn(
        "timestamp", F.timestamp_seconds("s")
    )
    expected, last = [], {}
    for i, meter, second, total in sorted((r for r in data if r[3] is not None), key=lambda r: (r[1], r[2], r[0])):
        if meter in last and total < last[meter]:
            expected.append((i, total, last[meter]))
        last[meter] = total
    for span in (60, 300, 10**6):
        got = op.detect_rollback(df.repartition(9), "total", ["timestamp", "id"], span)
        assert rows(got.select("id", "total", "previous")) == sorted(expected, key=repr)


def test_rollback_over_stretches_and_without_files(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr(
        "id", "if(id % 3 > 0, 7L, id) AS meterID", "timestamp_seconds(id) AS timestamp",
        "if(id % 50000 = 1, -1D, cast(id AS double)) AS total",
    )
    before = set(Path(shared_dir(spark)).rglob("*"))
    for span in (10, 3600, 86_400, 10**9):
        got = op.detect_rollback(df, "total", ["timestamp", "id"], span)
        assert sorted(r.id for r in got.collect()) == [i for i in (50_001, 100_001, 150_001) if i % 3 > 0]
    assert set(Path(shared_dir(spark)).rglob("*")) == before


def test_out_of_profile(spark):
    jan, apr = epoch("2024-01-10 03:00:00"), epoch("2024-04-10 03:00:00")
    data = [(1, 1, jan, 0.29), (2, 1, jan, 0.3), (3, 1, apr, 0.21), (4, 1, apr, 0.22), (5, 1, apr, 0.05), (6, 1, apr, None), (7, 1, None, 9.0)]
    got = op.out_of_profile(readings(spark, data))
    assert got.columns == ["meterID", "cityID", "timestamp", "activeDelta", "lower", "upper"]
    assert rows(got.select("meterID", F.round("lower", 3), F.round("upper", 3))) == [(2, 0.084, 0.294), (4, 0.06, 0.21), (5, 0.06, 0.21)]
    shifted = op.out_of_profile(readings(spark, [(1, 1, epoch("2024-04-10 05:30:00"), 0.5)]), tz="Europe/Sarajevo")
    assert shifted.count() == 0


def test_bands_by_hour_are_at_most_24_rows(spark):
    bands = spark.createDataFrame([(0, 99, 1.0, 2.0), (5, 6, 3.0, 4.0)], BAND)
    assert hourly_bounds(bands).count() == 24


def test_diff_aggregates(spark):
    keys = ["meterID", "unix_window"]
    actual = partials(spark, [(1, 1, 0, 1.000001), (2, 1, 0, 2.0), (3, 1, 0, 3.0), (4, 1, 0, None), (6, 1, 0, 1.0), (6, 1, 0, 6.0), (7, 1, 0, None)])
    expected = partials(spark, [(1, 1, 0, 1.0), (2, 1, 0, 2.1), (4, 1, 0, None), (5, 1, 0, 5.0), (6, 1, 0, 6.0), (7, 1, 0, 0.0)])
    got = op.diff_aggregates(actual, expected, keys)
    assert rows(got.drop("unix_window")) == sorted([
        (2, 2.0, 2.1, "different"), (3, 3.0, None, "unexpected"), (5, None, 5.0, "missing"), (7, None, 0.0, "different"),
    ], key=repr)


def test_rounding_is_half_up(spark):
    one = partials(spark, [(1, 1, 0, 0.000005)])
    other = partials(spark, [(1, 1, 0, 0.00001)])
    assert op.diff_aggregates(one, other, ["meterID"]).count() == 0


@contextmanager
def setting(spark, **values):
    names = {key: "spark.sql." + key.replace("_", ".") for key in values}
    before = {key: spark.conf.get(name) for key, name in names.items()}
    for key, value in values.items():
        spark.conf.set(names[key], value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(names[key], value)


def test_the_adaptive_join_splits_a_hot_key(spark):
    """Also below an aggregate that would otherwise reuse the partitioning of the join."""
    df = spark.range(0, 600_000, 1, 8).selectExpr("if(id % 3 = 0, 0L, id) AS k", "id AS v", "uuid() AS payload")
    dim = spark.range(600_000).selectExpr("id AS k", "id % 7 AS city")
    with setting(
        spark,
        autoBroadcastJoinThreshold=-1,
        adaptive_skewJoin_skewedPartitionThresholdInBytes="256KB",
        adaptive_advisoryPartitionSizeInBytes="256KB",
        shuffle_partitions=16,
    ):
        joined = lookup_join(df, dim, "k")
        result = joined.groupBy("k", "city").agg(F.sum("v").alias("s"), F.max("payload").alias("p"))
        assert result.where("k = 0").collect()[0].s == sum(range(0, 600_000, 3))
        result.collect()
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()


def test_small_tables_are_broadcast(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 0L, id % 100) AS k", "id AS v")
    dim = spark.range(90).selectExpr("id AS k", "id * 10 AS d")
    joined = lookup_join(df, dim, "k")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == df.where("k < 90").count()


def test_learnt_bounds_are_within_their_error(spark):
    """Against exact quantiles: the rank of a bound is wrong by less than the sketch's size promises."""
    n = 60_000
    day = "timestamp_seconds(1704067200 + (id * 37) % 2592000)"  # January 2024
    readings = spark.range(n).selectExpr(f"{day} AS timestamp", "pow(hash(id) / 2147483648.0D, 3) AS activeDelta", "id AS meterID")
    profiles = op.month_profiles(readings, k=200).unionByName(op.month_profiles(readings.where("false"), k=200))
    bounds = {r.daypart: r for r in op.learn_bounds(profiles, 0.05, 0.95).collect()}
    assert set(bounds) == {"night", "morning", "working", "evening"} and {r.season for r in bounds.values()} == {"Winter"}
    hours = {"night": (0, 6), "morning": (7, 8), "working": (9, 16), "evening": (17, 23)}
    for part, (first, last) in hours.items():
        values = sorted(r[0] for r in readings.where(f"hour(timestamp) BETWEEN {first} AND {last}").select("activeDelta").collect())
        for bound, rank in ((bounds[part].lower, 0.05), (bounds[part].upper, 0.95)):
            at = sum(v <= bound for v in values) / len(values)
            assert abs(at - rank) < 0.02
    flagged = op.out_of_learnt_profile(readings, op.learn_bounds(profiles, 0.05, 0.95)).count()
    assert abs(flagged / n - 0.1) < 0.03


def test_profiles_of_months_merge(spark):
    """Two months learnt one by one give the bounds of both together; odd readings are left out or not judged."""
    rows_ = [(f"2024-0{m}-10 {h:02d}:00:00", float(v)) for m in (1, 2) for h in (3, 12) for v in range(50 * (m - 1), 50 * m)]
    rows_ += [(None, 1.0), ("2024-01-10 03:00:00", None)]
    readings = spark.createDataFrame(rows_, "t string, activeDelta double").selectExpr("cast(t as timestamp) timestamp", "activeDelta")
    parts = [op.month_profiles(readings.where(f"month(timestamp) = {m}")) for m in (1, 2)]
    bounds = op.learn_bounds(parts[0].unionByName(parts[1]), 0.1, 0.9)
    assert sorted((r.season, r.daypart, r.lower, r.upper) for r in bounds.collect()) == [("Winter", "night", 9.0, 89.0), ("Winter", "working", 9.0, 89.0)]
    flagged = op.out_of_learnt_profile(readings, bounds)
    assert flagged.count() == 2 * (9 + 10) and flagged.columns == ["timestamp", "activeDelta", "lower", "upper"]
    summer = spark.createDataFrame([("2024-07-10 03:00:00", 1e9)], "t string, activeDelta double").selectExpr("cast(t as timestamp) timestamp", "activeDelta")
    assert op.out_of_learnt_profile(summer, bounds).count() == 0
