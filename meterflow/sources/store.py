"""The hourly store: Parquet in directories by year, month and city, to which runs only add.

Every run appends its rows with its number; nothing is rewritten, so a run costs what it
brings, however much is stored. Which row of an hour counts is settled when the store is
read. Compaction replaces the files of a month by fewer; it first adds the settled rows, under
the numbers they came with, and then removes the files it has read, so that the store says
the same at every moment in between and a run that was lost is simply repeated.

What is known about a month is kept under a digest of the names of its files: that it is settled, and
its totals by meter. Any run that adds a file to a month changes its digest, and so takes back what
was known, without knowing of it; months that nothing was added to are read as they are.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections import defaultdict
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.operators.reconcile import HOURLY_KEYS
from meterflow.schemas import HOURLY_STORE, TOTAL
from meterflow.session import adaptive_execution
from meterflow.shared import child_names, claim_name, file_names, files_digest, of_one_job, path_exists, remove_path

PARTITIONS = ("year", "month", "cityID")
#: Number of the run that brought a row; null for rows that are kept as they are.
RUN = "run"
_STORED = T.StructType([
    *[f for f in HOURLY_STORE.fields if f.name not in PARTITIONS],
    T.StructField(RUN, T.LongType()),
    *[f for f in HOURLY_STORE.fields if f.name in PARTITIONS],
])


_RUNS, _MARKS, _TOTALS = "_runs", "_settled", "_totals"
_GIVEN, _STAMP = "given", "stamp"
#: Claims of run numbers that are kept.
_CLAIMS = 100
_MONTH_TOTALS = "meterID LONG, cityID LONG, aggregatedActiveDelta DOUBLE, year INT, month INT"
_IN_MONTH = re.compile(r"/year=(\d+)/month=(\d+)/(.*)$")

Month = tuple[int, int]


class WriteReport(NamedTuple):
    """Incoming rows, and how many of them had no meter, city or window."""

    rows: int
    without_key: int


def _check(how: str) -> None:
    if how not in ("max", "latest"):
        raise ValueError(f"how must be 'max' or 'latest', not {how!r}")


def _settled(stored: DataFrame, how: str) -> DataFrame:
    """One row per hour, meter and city; its calendar columns follow from them."""
    calendar = ("date", "hour", "year", "month")
    value = F.max(TOTAL) if how == "max" else F.max_by(TOTAL, RUN)
    others = [F.max(name).alias(name) for name in ("date", "hour", RUN)]
    # year and month are grouping keys so that filters on them reach the directories
    keys = [*HOURLY_KEYS, *[name for name in calendar if name in PARTITIONS]]
    return stored.groupBy(*keys).agg(value.alias(TOTAL), *others)


def _month_files(spark: SparkSession, path: str) -> dict[Month, set[str]]:
    """The files of each month, from a listing of the folders."""
    months = defaultdict(set)
    for name in spark.read.schema(_STORED).parquet(path).inputFiles():
        if found := _IN_MONTH.search(unquote(name)):
            months[int(found[1]), int(found[2])].add(found[3])
    return dict(months)


def _mark(path: str, month: Month, how: str, files: set[str]) -> str:
    return f"{path.rstrip('/')}/{_MARKS}/{how}-{month[0]}-{month[1]}-{files_digest(files)}"


def _in_months(months: list[Month]) -> Column:
    """A condition on directory columns only."""
    return (F.col("year") * 100 + F.col("month")).isin([year * 100 + month for year, month in months])


def settled_months(spark: SparkSession, path: str, how: str = "max") -> list[Month]:
    """The months that were compacted and to which nothing was added since."""
    marks = set(child_names(spark, f"{path.rstrip('/')}/{_MARKS}"))
    if not marks:
        return []
    return sorted(m for m, files in _month_files(spark, path).items() if _mark(path, m, how, files).rsplit("/", 1)[1] in marks)


def read_hourly_store(spark: SparkSession, path: str, how: str = "max") -> DataFrame:
    """The store; a filter on year, month or cityID reads only those directories.

    Of an hour that several runs brought the larger value counts, or with ``how="latest"`` that of
    the last run. Rows that were appended as they are come as often as they are there. Settled
    months (:func:`settled_months`) are read as they are, without grouping them again.
    """
    _check(how)
    stored = spark.read.schema(_STORED).parquet(path)
    columns = HOURLY_STORE.fieldNames()
    closed = settled_months(spark, path, how)
    by_run, as_is = stored.where(F.col(RUN).isNotNull()), stored.where(F.col(RUN).isNull())
    out = _settled(by_run.where(~_in_months(closed)) if closed else by_run, how).select(*columns).unionByName(as_is.select(*columns))
    return out.unionByName(by_run.where(_in_months(closed)).select(*columns)) if closed else out


def claim_run(spark: SparkSession, path: str, label: str | None = None) -> int:
    """A number for a run that is larger than all before it: the clock in milliseconds, or one more than the last number.

    The numbers are claimed in the store itself, so that all jobs that write it count alike, whatever their
    clocks say. With the same ``label`` (as of a micro-batch that is repeated) it is the same number again.
    """
    base = f"{path.rstrip('/')}/{_RUNS}"
    ending = "" if label is None else "-" + hashlib.sha256(label.encode()).hexdigest()
    while True:
        names = child_names(spark, base)
        if _GIVEN in names:
            raise ValueError(f"the runs of {path} are numbered by their writer; go on with larger numbers of your own")
        claims = [name for name in names if name[0].isdigit()]
        for name in claims:
            if ending and name.endswith(ending):
                return int(name.split("-")[0])
        last = int(claims[-1].split("-")[0]) if claims else 0
        number = max(time.time_ns() // 1_000_000, last + 1)
        # the claim of a number is the file without a label; two jobs that count at once cannot both make it
        if claim_name(spark, f"{base}/{number:020d}"):
            if ending:
                claim_name(spark, f"{base}/{number:020d}{ending}")
            for name in claims[:-_CLAIMS]:
                remove_path(spark, f"{base}/{name}")
            return number


def _given_run(spark: SparkSession, path: str, run: int) -> int:
    base = f"{path.rstrip('/')}/{_RUNS}"
    if any(name[0].isdigit() for name in child_names(spark, base)):
        raise ValueError(f"the runs of {path} are numbered by the store; a number of one's own would not be in their order")
    claim_name(spark, f"{base}/{_GIVEN}")
    return run


def write_hourly_store(
    df: DataFrame, path: str, mode: str = "merge", *, run: int | None = None, label: str | None = None
) -> WriteReport:
    """Add final hourly values (see ``build_hourly_store``); rows without a key are dropped and counted.

    ``merge`` may be repeated: the rows carry the number of the run (:func:`claim_run`, by ``label``), and of an hour
    that is there several times one counts, as the reader says. A writer may number its runs
    itself by ``run``, but then it has to do so always: a store is not numbered in two ways. ``append`` adds rows that all
    count, so a second run doubles them. The store must always be written with the same calendar zone.
    """
    if mode not in ("merge", "append"):
        raise ValueError(f"mode must be 'merge' or 'append', not {mode!r}")
    spark, number = df.sparkSession, None
    if mode == "merge":
        number = claim_run(spark, path, label) if run is None else _given_run(spark, path, run)
    no_key = F.col("meterID").isNull() | F.col("cityID").isNull() | F.col("unix_window.start").isNull()
    seen = Observation()
    keyed = (
        df.select(*HOURLY_STORE.fieldNames())
        .observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(no_key).alias("without_key"))
        .where(~no_key)
    )
    _append(keyed.withColumn(RUN, F.lit(number).cast("long")), path)
    return WriteReport(seen.get["rows"], seen.get["without_key"])


def _append(df: DataFrame, path: str) -> None:
    """Rows of a directory together; AQE splits a directory that is too large for one task."""
    with adaptive_execution(df.sparkSession):
        (
            df.select(*_STORED.fieldNames())
            .hint("rebalance", *PARTITIONS)
            .write.mode("append")
            .partitionBy(*PARTITIONS)
            .parquet(path)
        )


def compact_hourly_store(spark: SparkSession, path: str, year: int, month: int, how: str = "max") -> int:
    """Settle one month into few files; the number of files that it replaced.

    Meant for months that are closed, or at least while nothing else compacts them: rows that
    are added meanwhile lie in files that are neither read nor removed. If the job is lost, what
    it added is settled with the rest, and it may be run again.
    """
    _check(how)
    if not path_exists(spark, f"{path.rstrip('/')}/year={year}/month={month}"):
        return 0
    here = (F.col("year") == year) & (F.col("month") == month)
    files = spark.read.schema(_STORED).parquet(path).where(here & F.col(RUN).isNotNull())
    names = file_names(files)
    if not names:
        return 0
    read_ = {_IN_MONTH.search(name)[3] for name in names}
    others = _month_files(spark, path)[year, month] - read_
    # a file holds rows of one kind only, as each comes from one run
    read = spark.read.schema(_STORED).option("basePath", path).parquet(*names)
    _append(_settled(read, how), path)
    for name in names:
        remove_path(spark, name)
    left = _month_files(spark, path).get((year, month), set())
    # only if all that is new comes from this job, and all that was there before is gone or was not read
    if of_one_job(left - others) and not left & read_ and _all_as_is(spark, path, year, month, others & left):
        claim_name(spark, _mark(path, (year, month), how, left))
    return len(names)


def _all_as_is(spark: SparkSession, path: str, year: int, month: int, files: set[str]) -> bool:
    """Whether files hold only rows that are kept as they are: none was added by a run since the names were read."""
    if not files:
        return True
    paths = [f"{path.rstrip('/')}/year={year}/month={month}/{name}" for name in sorted(files)]
    stored = spark.read.schema(_STORED).option("basePath", path).parquet(*paths)
    return not stored.where(F.col(RUN).isNotNull()).take(1)


def _stamps(spark: SparkSession, path: str) -> dict[Month, str]:
    """A name of each month with its digest."""
    return {m: f"{m[0]}-{m[1]}-{files_digest(files)}" for m, files in _month_files(spark, path).items()}


def _totals_base(path: str, how: str) -> str:
    return f"{path.rstrip('/')}/{_TOTALS}/{how}"


def _by_meter(hist: DataFrame) -> DataFrame:
    return hist.groupBy("meterID", "cityID", "year", "month").agg(F.sum(TOTAL).alias(TOTAL))


def update_month_totals(spark: SparkSession, path: str, how: str = "max") -> list[Month]:
    """Keep the totals by meter and city of all months up to date; the months that had to be summed.

    Only months whose files have changed are read, all of them by one job, and kept under the digest of their files. A month
    counts as kept once the job is done; a job that is lost is simply repeated. What is kept of older files is removed after.
    """
    _check(how)
    base, stamps = _totals_base(path, how), _stamps(spark, path)
    known = set(child_names(spark, f"{base}/done"))
    stale = sorted(m for m, stamp in stamps.items() if stamp not in known)
    if stale:
        names = F.create_map(*[F.lit(x) for m in stale for x in (m[0] * 100 + m[1], stamps[m])])
        sums = _by_meter(read_hourly_store(spark, path, how).where(_in_months(stale))).withColumn(
            _STAMP, F.element_at(names, F.col("year") * 100 + F.col("month"))
        )
        with adaptive_execution(spark):
            (
                sums.hint("rebalance", _STAMP)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(_STAMP)
                .parquet(f"{base}/months")
            )
        for month in stale:
            claim_name(spark, f"{base}/done/{stamps[month]}")
    for stamp in known - set(stamps.values()):
        remove_path(spark, f"{base}/done/{stamp}")
        remove_path(spark, f"{base}/months/{_STAMP}={stamp}")
    return stale


def read_month_totals(spark: SparkSession, path: str, how: str = "max") -> DataFrame:
    """(meterID, cityID, year, month, total) of the store, for questions by year or month.

    Totals that :func:`update_month_totals` has kept are read instead of the hours; months that have changed since are
    summed from their hours. The answer is that of the store at this moment either way.
    """
    _check(how)
    base, stamps = _totals_base(path, how), _stamps(spark, path)
    done = set(child_names(spark, f"{base}/done"))
    kept = sorted(m for m, stamp in stamps.items() if stamp in done)
    columns = [c.split()[0] for c in _MONTH_TOTALS.split(", ")]
    rest = read_hourly_store(spark, path, how)
    summed = _by_meter(rest.where(~_in_months(kept)) if kept else rest).select(*columns)
    if not kept:
        return summed
    # the stamp is a directory column: only the folders of these months are opened
    stored = spark.read.schema(f"{_MONTH_TOTALS}, {_STAMP} STRING").parquet(f"{base}/months")
    stored = stored.where(F.col(_STAMP).isin([stamps[m] for m in kept])).select(*columns)
    return stored if len(kept) == len(stamps) else stored.unionByName(summed)
