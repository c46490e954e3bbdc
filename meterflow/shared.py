"""Tables written to the folder that all nodes share."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from functools import lru_cache
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="meterflow-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local master may go without."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_dir()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses, until :func:`drop_scratch`."""
    path = f"{shared_dir(spark)}/meterflow/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def scratch_mark() -> int:
    """For :func:`drop_scratch`: how many paths there are by now."""
    return len(_scratch)


def drop_scratch(spark: SparkSession, since: int = 0, keep: str | None = None) -> int:
    """Remove what this process has in the shared folder, once the results that read it are written; how many paths.

    ``since`` spares what was there at that :func:`scratch_mark`, ``keep`` one path.
    """
    own = [path for path in _scratch[since:] if path != keep]
    paths = [path for path in own if path_exists(spark, path)]
    _scratch[since:] = [path for path in _scratch[since:] if path == keep]
    for path in paths:
        remove_path(spark, path)
    return len(paths)


def written_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a path in the shared folder and return the written table.

    It cuts the lineage: later steps see the same rows whatever the source does, and a
    lost executor costs a re-read.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_names(df: DataFrame) -> list[str]:
    """The files that the rows of ``df`` come from."""
    return sorted(unquote(r[0]) for r in df.select(F.input_file_name()).distinct().collect())


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


_JOB = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")


def files_digest(files: set[str]) -> str:
    """A digest of the names of files. Every write makes new names, so what is known of the files can be kept under it."""
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


def of_one_job(files: set[str]) -> bool:
    """Whether files that Spark wrote come from one and the same write."""
    return len({found[0] for name in files if (found := _JOB.search(name))}) == 1


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, in ascending order; none if it isn't there."""
    fs, folder = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def claim_name(spark: SparkSession, path: str) -> bool:
    """Make an empty file; false if somebody else has made it before."""
    fs, hadoop_path = _file_system(spark, path)
    try:
        return fs.createNewFile(hadoop_path)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise


def order_files(spark: SparkSession, path: str) -> int:
    """Give the data files of a folder ascending times in the order of their names; how many there are.

    A file stream takes the files of a folder by their time.
    """
    fs, folder = _file_system(spark, path)
    names = sorted(str(f.getPath()) for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    first = min((f.getModificationTime() for f in fs.listStatus(folder)), default=0) // 1000 * 1000 - 1000 * len(names)
    for k, name in enumerate(names):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), first + 1000 * k, -1)
    return len(names)
