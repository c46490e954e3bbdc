import pytest
from helpers import epoch, partials, rows

from meterflow import operators as op
from meterflow.sources import store
from meterflow.sources.files import read_city_dim, read_json_dump, write_snapshot
from meterflow.sources.store import (
    compact_hourly_store,
    read_hourly_store,
    read_month_totals,
    settled_months,
    update_month_totals,
    write_hourly_store,
)

MAY = epoch("2022-05-31 22:00:00")
JUNE = epoch("2022-06-01 00:00:00")


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def values(df):
    return rows(df.select("meterID", "cityID", "unix_window.start", "aggregatedActiveDelta"))


def test_reconcile_max_and_latest(spark):
    rising = partials(spark, [(1, 1, 0, 1.0), (1, 1, 0, 3.0), (1, 1, 0, 2.5), (1, 2, 0, 9.0), (1, 1, 3600, 4.0)])
    assert values(op.reconcile(rising)) == sorted([(1, 1, 0, 3.0), (1, 1, 3600, 4.0), (1, 2, 0, 9.0)], key=repr)
    signed = spark.createDataFrame([(1, 5.0, 0, 1), (1, -2.0, 0, 2), (1, 7.0, 1, 0)], "k long, v double, gen int, batch int")
    assert rows(op.reconcile(signed, ["k"], "latest", value="v", order_by=["gen", "batch"])) == [(1, 7.0)]
    assert rows(op.reconcile(signed, ["k"], "latest", value="v", order_by="batch")) == [(1, -2.0)]
    with pytest.raises(ValueError):
        op.reconcile(signed, ["k"], "latest", value="v")
    with pytest.raises(ValueError):
        op.reconcile(signed, ["k"], "min", value="v")


def test_compacted_messages(spark):
    df = spark.createDataFrame(
        [("a", "1", 0), ("a", "2", 5), ("b", "3", 1), ("b", None, 2), (None, "4", 3)],
        "key string, value string, offset long",
    )
    assert rows(op.compact_latest(df)) == [("a", "2")]


def test_store_layout(spark, path):
    built = op.build_hourly_store(partials(spark, [(1, 3_000_000_000, MAY, 2.0), (1, 3_000_000_000, MAY, 1.0)]), tz="Europe/Sarajevo")
    assert write_hourly_store(built, path) == (1, 0)
    (row,) = read_hourly_store(spark, path).collect()
    assert (row.year, row.month, row.hour, row.cityID) == (2022, 6, 0, 3_000_000_000)
    assert dict(read_hourly_store(spark, path).dtypes)["cityID"] == "bigint"


def test_repetition_changes_nothing(spark, path):
    run = op.build_hourly_store(partials(spark, [(1, 1, MAY, 2.0), (2, 1, JUNE, 3.0)]))
    write_hourly_store(run, path)
    before = values(read_hourly_store(spark, path))
    write_hourly_store(run, path)
    assert values(read_hourly_store(spark, path)) == before


def test_merge_keeps_older_hours_and_larger_values(spark, path):
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 2.0), (1, 1, MAY + 3600, 5.0), (1, 2, MAY, 1.0)])), path)
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY + 3600, 4.0), (1, 1, JUNE, 7.0), (2, 1, MAY, 6.0)])), path)
    assert values(read_hourly_store(spark, path)) == sorted([
        (1, 1, MAY, 2.0), (1, 1, MAY + 3600, 5.0), (1, 1, JUNE, 7.0), (1, 2, MAY, 1.0), (2, 1, MAY, 6.0),
    ], key=repr)


def test_the_last_run_can_count(spark, path):
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 5.0)])), path, run=7)
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 4.0)])), path, run=8)
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 4.5)])), path, run=6)
    assert values(read_hourly_store(spark, path, "latest")) == [(1, 1, MAY, 4.0)]
    assert values(read_hourly_store(spark, path)) == [(1, 1, MAY, 5.0)]
    with pytest.raises(ValueError):
        read_hourly_store(spark, path, "min")


def files(tmp_path):
    return {f: f.stat().st_mtime_ns for f in tmp_path.glob("store/year=*/month=*/cityID=*/*.parquet")}


def test_a_run_only_adds_files(spark, path, tmp_path):
    write_hourly_store(op.build_hourly_store(partials(spark, [(m, 1, MAY, 2.0) for m in range(50)])), path)
    before = files(tmp_path)
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 3.0)])), path)
    after = files(tmp_path)
    assert {f: after[f] for f in before} == before and len(after) == len(before) + 1
    assert values(read_hourly_store(spark, path).where("meterID < 3")) == [(0, 1, MAY, 2.0), (1, 1, MAY, 3.0), (2, 1, MAY, 2.0)]


@pytest.mark.parametrize("how", ["max", "latest"])
def test_compaction(spark, path, tmp_path, how):
    for run, total in enumerate([2.0, 9.0, 4.0]):
        write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, total), (2, 2, MAY, 1.0), (1, 1, JUNE, total)])), f"{path}/", run=run)
    write_hourly_store(op.build_hourly_store(partials(spark, [(5, 1, MAY, 1.0)])), path, "append")
    before, june = values(read_hourly_store(spark, path, how)), set(tmp_path.glob("store/year=2022/month=6/*/*"))
    assert compact_hourly_store(spark, path, 2022, 5, how) == 6
    assert values(read_hourly_store(spark, path, how)) == before
    assert set(tmp_path.glob("store/year=2022/month=6/*/*")) == june
    assert len([f for f in files(tmp_path) if "month=5" in str(f)]) == 3
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 3.0)])), path, run=1)
    assert values(read_hourly_store(spark, path, how)) == before
    assert compact_hourly_store(spark, path, 2022, 5, how) == 3
    assert values(read_hourly_store(spark, path, how)) == before
    assert compact_hourly_store(spark, path, 1999, 1) == 0


def test_a_lost_compaction_changes_nothing(spark, path, monkeypatch):
    for run in range(2):
        write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 2.0 + run), (2, 1, MAY, 3.0)])), path, run=run)
    before = values(read_hourly_store(spark, path))

    class Lost(Exception):
        pass

    def lost(*_):
        raise Lost

    with monkeypatch.context() as m:
        m.setattr(store, "remove_path", lost)
        with pytest.raises(Lost):
            compact_hourly_store(spark, path, 2022, 5)
    assert values(read_hourly_store(spark, path)) == before
    assert compact_hourly_store(spark, path, 2022, 5) == 3
    assert values(read_hourly_store(spark, path)) == before


def test_rows_without_a_key_are_dropped_and_counted(spark, path):
    data = [(1, 1, MAY, 2.0), (None, 1, MAY, 2.0), (1, None, MAY, 2.0), (1, 1, None, 2.0)]
    assert write_hourly_store(op.build_hourly_store(partials(spark, data)), path) == (4, 3)
    assert values(read_hourly_store(spark, path)) == [(1, 1, MAY, 2.0)]


def test_nothing_to_write(spark, path):
    assert write_hourly_store(op.build_hourly_store(partials(spark, [(None, 1, MAY, 2.0)])), path) == (1, 1)


def test_append_doubles(spark, path):
    run = op.build_hourly_store(partials(spark, [(1, 1, MAY, 2.0)]))
    write_hourly_store(run, path, mode="append")
    write_hourly_store(run, path, mode="append")
    assert values(read_hourly_store(spark, path)) == [(1, 1, MAY, 2.0)] * 2
    with pytest.raises(ValueError):
        write_hourly_store(run, path, mode="replace")


def test_reading_prunes_directories(spark, path):
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 2.0), (1, 1, JUNE, 3.0)])), path)
    plan = op.for_year(read_hourly_store(spark, path), 2022)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "PushedFilters: [IsNotNull(run)]" in plan and "PushedFilters: [IsNull(run)]" in plan


def test_a_large_directory_is_split_between_tasks(spark, path, tmp_path):
    """One city holds nearly everything; its rows end up in several files."""
    hot = spark.range(0, 400_000, 1, 8).selectExpr("id % 50000 AS meterID", "1L AS cityID", f"{MAY}L + id div 50000 * 3600 - 36000 AS start", "rand(7) AS aggregatedActiveDelta")
    df = hot.selectExpr("meterID", "cityID", "named_struct('start', start, 'end', start + 3600) AS unix_window", "aggregatedActiveDelta")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_hourly_store(op.build_hourly_store(df), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(tmp_path.glob("store/year=2022/month=5/cityID=1/*.parquet"))) > 1
    assert read_hourly_store(spark, path).count() == 400_000


def test_one_file_per_small_directory_also_without_aqe(spark, path, tmp_path):
    data = [(m, c, MAY + 3600 * h, 1.0) for m in range(20) for c in (1, 2) for h in range(3)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_hourly_store(op.build_hourly_store(partials(spark, data)), path)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list(tmp_path.glob("store/year=*/month=*/cityID=*/*.parquet"))) == 4


def test_snapshots_and_city_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "a long, b double")
    for fmt in ("json", "parquet"):
        write_snapshot(df, str(tmp_path / fmt), fmt)
        write_snapshot(df, str(tmp_path / fmt), fmt)
    assert rows(spark.read.parquet(str(tmp_path / "parquet"))) == rows(df)
    assert rows(read_json_dump(spark, str(tmp_path / "json"), multiline=False)) == rows(df)
    with pytest.raises(ValueError):
        write_snapshot(df, str(tmp_path / "orc"), "orc")
    dump = tmp_path / "dump.json"
    dump.write_text('[\n {"meterID": 1,\n  "x": 2},\n {"meterID": 3}\n]')
    assert rows(read_json_dump(spark, str(dump)).select("meterID")) == [(1,), (3,)]
    csv = tmp_path / "cities.csv"
    csv.write_text("cityID,latitude,longitude,cityName\n1,44.77,17.19,Banja Luka\n")
    assert rows(read_city_dim(spark, str(csv))) == [(1, 44.77, 17.19, "Banja Luka")]


def test_settled_months_are_not_grouped_again(spark, path):
    for total in (2.0, 9.0):
        write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, total), (2, 1, JUNE, total)])), path)
    write_hourly_store(op.build_hourly_store(partials(spark, [(3, 1, MAY, 1.0)])), path, "append")
    assert settled_months(spark, path) == []
    before = values(read_hourly_store(spark, path))
    compact_hourly_store(spark, path, 2022, 5)
    assert settled_months(spark, path) == [(2022, 5)] and settled_months(spark, path, "latest") == []
    assert values(read_hourly_store(spark, path)) == before
    may = read_hourly_store(spark, path).where("year = 2022 AND month = 5")
    may.collect()
    final = may._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange" not in final and "Aggregate" not in final
    # a run that adds to the month takes the mark back, whichever job it is of
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 11.0)])), path)
    assert settled_months(spark, path) == []
    assert (1, 1, MAY, 11.0) in values(read_hourly_store(spark, path))
    assert len(values(read_hourly_store(spark, path))) == len(before)


def test_a_month_that_is_added_to_while_it_is_compacted_is_not_settled(spark, path, monkeypatch):
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 2.0)])), path)
    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 3.0)])), path)
    remove, added = store.remove_path, []

    def meanwhile(session, name):
        if not added:
            added.append(write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 7.0)])), path))
        remove(session, name)

    monkeypatch.setattr(store, "remove_path", meanwhile)
    compact_hourly_store(spark, path, 2022, 5)
    assert settled_months(spark, path) == []
    assert values(read_hourly_store(spark, path)) == [(1, 1, MAY, 7.0)]


def test_runs_of_all_jobs_are_numbered_in_one_order(spark, path, monkeypatch):
    """A batch job's run, then micro-batches, then one of a driver whose clock is behind."""
    run = lambda total, **options: write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, total)])), path, **options)
    latest = lambda: values(read_hourly_store(spark, path, "latest"))
    run(5.0)
    run(3.0, label="checkpoint#0")
    assert latest() == [(1, 1, MAY, 3.0)]
    run(4.0)
    run(3.0, label="checkpoint#0")  # the micro-batch is repeated: it says the same again
    assert latest() == [(1, 1, MAY, 4.0)]
    run(6.0, label="checkpoint#1")
    monkeypatch.setattr(store.time, "time_ns", lambda: 1_000_000_000)
    run(2.0)
    assert latest() == [(1, 1, MAY, 2.0)]
    with pytest.raises(ValueError, match="numbered by the store"):
        run(1.0, run=7)


def test_numbers_of_the_writer_are_not_mixed_with_the_stores(spark, path):
    run = op.build_hourly_store(partials(spark, [(1, 1, MAY, 1.0)]))
    write_hourly_store(run, path, run=3)
    write_hourly_store(run, path, run=4)
    write_hourly_store(run, path, "append")
    with pytest.raises(ValueError, match="numbered by their writer"):
        write_hourly_store(run, path)


def test_month_totals_follow_the_store(spark, path):
    def yearly():
        return rows(op.yearly_by_meter(read_month_totals(spark, path)))

    def direct():
        return rows(op.yearly_by_meter(read_hourly_store(spark, path)))

    write_hourly_store(op.build_hourly_store(partials(spark, [(1, 1, MAY, 2.0), (1, 1, MAY + 3600, 1.0), (2, 1, JUNE, 3.0)])), path)
    assert yearly() == direct() == [(2022, 1, 3.0), (2022, 2, 3.0)]
    assert update_month_totals(spark, path) == [(2022, 5), (2022, 6)]
    assert update_month_totals(spark, path) == []
    assert all("_totals" in name for name in read_month_totals(spark, path).inputFiles())
    # a job that is lost before it is done is simply repeated
    store.remove_path(spark, next(f"{path}/_totals/max/done/{n}" for n in store.child_names(spark, f"{path}/_totals/max/done")))
    assert update_month_totals(spark, path) == [(2022, 5)] and yearly() == direct()
    # a late run: June is summed from its hours until its totals are made anew, May is not read
    write_hourly_store(op.build_hourly_store(partials(spark, [(2, 1, JUNE, 8.0), (1, 1, JUNE, 1.5)])), path)
    assert yearly() == direct() == [(2022, 1, 4.5), (2022, 2, 8.0)]
    from_hours = read_month_totals(spark, path).where("month = 5")
    assert rows(from_hours) == [(1, 1, 3.0, 2022, 5)]
    assert update_month_totals(spark, path) == [(2022, 6)]
    assert yearly() == direct()
    # compaction changes the files, not the answer
    compact_hourly_store(spark, path, 2022, 6)
    assert yearly() == direct()
    assert update_month_totals(spark, path) == [(2022, 6)]
    assert yearly() == direct() == [(2022, 1, 4.5), (2022, 2, 8.0)]
    assert [len(store.child_names(spark, f"{path}/_totals/max/done"))] == [2]
    assert len([n for n in store.child_names(spark, f"{path}/_totals/max/months") if n.startswith("stamp=")]) == 2
