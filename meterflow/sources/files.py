"""File sources and plain file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterflow.schemas import CITY


def read_city_dim(spark: SparkSession, path: str) -> DataFrame:
    """The city table: CSV with a header."""
    return spark.read.option("header", True).schema(CITY).csv(path)


def read_json_dump(
    spark: SparkSession, path: str, multiline: bool = True, schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON files. A ``multiline`` file is read whole by one task; without a schema the data is read twice."""
    reader = spark.read.option("multiLine", multiline)
    return (reader if schema is None else reader.schema(schema)).json(path)


def write_snapshot(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Replace what is at ``path``, as JSON or Parquet."""
    if fmt not in ("json", "parquet"):
        raise ValueError(f"fmt must be 'json' or 'parquet', not {fmt!r}")
    df.write.mode("overwrite").format(fmt).save(path)
