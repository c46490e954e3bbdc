"""A sink whose micro-batches are visible as a whole or not at all, as a Python data source.

Each task writes one file and reports its name. Only when all tasks of a batch are done does the driver write a
manifest with the names, in one step; a file that no manifest names doesn't exist for readers, whether its task failed, was
run twice, or its batch was given up. A batch that is repeated after a failure writes new files and replaces its manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from meterflow.streaming.sinks import BATCH_ORDER, checkpointed, triggered

FORMAT = "meterflow-committed"
_MANIFEST = "generation INT, batch LONG, files ARRAY<STRING>"


@dataclass
class _Written(WriterCommitMessage):
    """The file of a task, or none if it had no rows."""

    file: str | None


def _place(path: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pa.fs.LocalFileSystem(), path.rstrip("/")
    return pa.fs.FileSystem.from_uri(path.rstrip("/"))


class _BatchWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path, self.generation = options["path"], int(options.get("generation", 0))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, base = _place(self.path)
        name, writer = f"{uuid.uuid4().hex}.parquet", None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                fs.create_dir(f"{base}/data", recursive=True)
                writer = pq.ParquetWriter(f"{base}/data/{name}", batch.schema, filesystem=fs)
            writer.write_batch(batch)
        if writer is None:
            return _Written(None)
        writer.close()
        return _Written(name)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        fs, base = _place(self.path)
        fs.create_dir(f"{base}/batches", recursive=True)
        files = sorted(m.file for m in messages if m is not None and m.file)
        manifest = json.dumps({"generation": self.generation, "batch": batchId, "files": files})
        # hidden until it is whole
        draft = f"{base}/batches/.{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(manifest.encode())
        fs.move(draft, f"{base}/batches/{self.generation:06d}-{batchId:012d}.json")

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        fs, base = _place(self.path)
        for message in messages:
            if message is not None and message.file:
                fs.delete_file(f"{base}/data/{message.file}")


class CommittedSink(DataSource):
    """The data source; it only writes streams. Its ``path`` must be one that all nodes share and Arrow can open."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _BatchWriter(self.options)


def write_committed(
    df: DataFrame, path: str, checkpoint: str, *, generation: int = 0, available_now: bool = False
) -> StreamingQuery:
    """Keep what every micro-batch emits in append mode; :func:`read_committed` sees whole batches only.

    For a stream of messages or points; sums that change need the point table (``sinks.upsert_points``), as Spark lets such sinks
    only append. Batch numbers begin again with a new checkpoint: raise ``generation`` then.
    """
    df.sparkSession.dataSource.register(CommittedSink)
    writer = df.writeStream.outputMode("append").format(FORMAT).option("path", path).option("generation", generation)
    return triggered(checkpointed(writer, checkpoint), available_now).start()


def read_committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of committed batches, with their ``generation`` and ``batch``."""
    base = path.rstrip("/")
    manifests = spark.read.schema(_MANIFEST).json(f"{base}/batches")
    named = manifests.select(*BATCH_ORDER, F.explode("files").alias("_file"))
    stored = spark.read.schema(schema).parquet(f"{base}/data")
    return (
        stored.withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
        .join(named, "_file")
        .select(*schema.fieldNames(), *BATCH_ORDER)
    )
