"""The sink whose batches are visible as a whole or not at all."""

import json
import os
import time

import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from meterflow.streaming.committed import read_committed, write_committed

SCHEMA = "id LONG, value DOUBLE"


@pytest.fixture
def feed(spark, tmp_path):
    folder = tmp_path / "input"
    folder.mkdir()

    def add(*records):
        count = len(list(folder.iterdir()))
        path = folder / f"{count:04d}.json"
        path.write_text("\n".join(json.dumps({"id": i, "value": v}) for i, v in records) + "\n")
        stamp = time.time() - 10_000 + count
        os.utime(path, (stamp, stamp))

    add.stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
    return add


def run(df, tmp_path, **options):
    path = f"file://{tmp_path}/out"
    write_committed(df, path, str(tmp_path / "checkpoint"), available_now=True, **options).awaitTermination()
    return path


def test_batches_with_their_numbers(spark, feed, tmp_path):
    feed((1, 1.0), (2, 2.0))
    feed((3, None))
    path = run(feed.stream(), tmp_path, generation=2)
    assert rows(read_committed(spark, path, feed.stream().schema)) == sorted([(1, 1.0, 2, 0), (2, 2.0, 2, 0), (3, None, 2, 1)], key=repr)


def test_a_batch_with_a_lost_task_is_not_there(spark, feed, tmp_path):
    """One of a batch's tasks fails after others have written: nothing of the batch is seen, and after the repair all of it once."""
    feed((1, 1.0))
    feed(*[(i, float(i)) for i in range(10, 50)])
    broken = feed.stream().repartition(4).withColumn(
        "value", F.when(F.col("id") == 42, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("value"))
    )
    with pytest.raises(StreamingQueryException):
        run(broken, tmp_path)
    path, schema = f"file://{tmp_path}/out", feed.stream().schema
    assert rows(read_committed(spark, path, schema)) == [(1, 1.0, 0, 0)]
    run(feed.stream().repartition(4), tmp_path)
    assert sorted(r.id for r in read_committed(spark, path, schema).collect()) == [1, *range(10, 50)]


def test_files_that_no_batch_names_are_not_read(spark, feed, tmp_path):
    """What a task left behind that was lost before its batch, or ran a second time."""
    feed((1, 1.0))
    path = run(feed.stream(), tmp_path)
    (file,) = (tmp_path / "out" / "data").glob("*.parquet")
    pq.write_table(pq.read_table(file), tmp_path / "out" / "data" / "left-behind.parquet")
    assert rows(read_committed(spark, path, feed.stream().schema)) == [(1, 1.0, 0, 0)]


def test_a_repeated_batch_replaces_itself(spark, feed, tmp_path):
    feed((1, 1.0))
    run(feed.stream(), tmp_path)
    for f in (tmp_path / "checkpoint" / "commits").iterdir():
        os.remove(f)
    path = run(feed.stream(), tmp_path)
    assert rows(read_committed(spark, path, feed.stream().schema)) == [(1, 1.0, 0, 0)]
    assert len(list((tmp_path / "out" / "batches").glob("*.json"))) == 1
