"""JSON messages in a key/value frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PARSED = "_parsed"


def _all_present(parent: str, schema: T.StructType) -> Column:
    checks = [F.col(parent).isNotNull()]
    for field in schema.fields:
        name = f"{parent}.{field.name}"
        nested = isinstance(field.dataType, T.StructType)
        checks.append(_all_present(name, field.dataType) if nested else F.col(name).isNotNull())
    return reduce(and_, checks)


def parse_messages(
    df: DataFrame,
    schema: T.StructType,
    quarantine: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decode the JSON in ``value`` and flatten it; ``keep`` carries source columns along.

    A malformed message becomes an all-null row, and a field of the wrong type becomes
    null while its row survives. With ``quarantine`` every row also says whether it is
    ``complete``, that is has every field, and brings its untouched ``value``: one pass over
    the source, whatever is then done with the two kinds.
    """
    # The one-element explode is a fence. Without it the optimizer copies from_json into every
    # filter on a parsed field, and each message is parsed several times.
    decoded = F.from_json(F.col("value").cast("string"), schema)
    parsed = df.withColumn(_PARSED, F.explode(F.array(decoded)))
    flat = [*keep, f"{_PARSED}.*"]
    if quarantine:
        flat += [_all_present(_PARSED, schema).alias("complete"), "value"]
    return parsed.select(*flat)


def message_key(cols: str | Sequence[str]) -> Column:
    """One column as text, or several as the text of their struct: ``{1, {0, 3600}}``."""
    if isinstance(cols, str):
        return F.col(cols).cast("string")
    return F.struct(*cols).cast("string")


def encode_json(
    df: DataFrame, key: str | Sequence[str] | None = None, ignore_null_fields: bool = True
) -> DataFrame:
    """The whole row as a JSON ``value``, with a message ``key`` if one is named."""
    options = {"ignoreNullFields": str(ignore_null_fields).lower()}
    out = [F.to_json(F.struct("*"), options).alias("value")]
    if key is not None:
        out.append(message_key(key).alias("key"))
    return df.select(*out)
