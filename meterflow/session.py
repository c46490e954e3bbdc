"""Session settings and the small helpers that hang off a session."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings that only change how a query is run. They may be set at any time.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even if the aggregate above then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

#: State of streams on the executors' disks; operators with state of their own need it.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def session_conf(
    *,
    shuffle_partitions: int | None = None,
    tz: str = "UTC",
    large_state: bool = False,
    single_stateful_operator: bool = False,
    initial_partitions: int | None = None,
    fair_scheduling: bool = False,
    s3a_endpoint: str | None = None,
) -> dict[str, str]:
    """Settings for a batch or streaming session.

    ``shuffle_partitions`` falls back to ``METERFLOW_SHUFFLE_PARTITIONS``; a stream's first
    checkpoint freezes the number. Batches begin with ``initial_partitions`` (or
    ``METERFLOW_INITIAL_PARTITIONS``), which AQE only ever merges: make it so large that a
    partition of the largest shuffle fits into a task. ``fair_scheduling`` lets the pools in which
    the queries of the streaming job run take turns. ``large_state`` moves window state out of
    the executor heap. ``single_stateful_operator`` drops rows behind the watermark
    in the very next batch instead of one batch later. Storage credentials are
    never set here: S3A finds them in its own provider chain.
    """
    conf = {
        "spark.sql.session.timeZone": tz,
        **ADAPTIVE,
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.parquet.mergeSchema": "false",
        "spark.hadoop.parquet.summary.metadata.level": "NONE",
    }
    partitions = shuffle_partitions or os.environ.get("METERFLOW_SHUFFLE_PARTITIONS")
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(int(partitions))
    initial = initial_partitions or os.environ.get("METERFLOW_INITIAL_PARTITIONS")
    if initial:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(int(initial))
    if large_state:
        conf.update(LARGE_STATE)
    if single_stateful_operator:
        conf["spark.sql.streaming.statefulOperator.allowMultiple"] = "false"
    if fair_scheduling:
        conf["spark.scheduler.mode"] = "FAIR"
    endpoint = s3a_endpoint or os.environ.get("METERFLOW_S3A_ENDPOINT")
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(endpoint.startswith("https")).lower()
    return conf


def build_session(app_name: str, master: str | None = None, **options) -> SparkSession:
    """A session with :func:`session_conf`; the master stays with spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in session_conf(**options).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def make_adaptive(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a session that someone else built."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def adaptive_execution(spark: SparkSession) -> Iterator[None]:
    """AQE for the queries inside, whatever the session says.

    Without it Spark ignores a ``rebalance`` hint: many small partitions would not be joined
    into few files, and a large folder would not be split.
    """
    with _settings(spark, {"spark.sql.adaptive.enabled": "true"}):
        yield


@contextmanager
def large_state(spark: SparkSession) -> Iterator[None]:
    """The RocksDB state store for the streams that are started inside; they keep it."""
    with _settings(spark, LARGE_STATE):
        yield


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose ``df`` to SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def preview(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """Print the schema and the first ``n`` rows. A debugging aid: it runs a job."""
    df.printSchema()
    df.show(n, truncate)
