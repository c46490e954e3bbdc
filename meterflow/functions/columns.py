"""Column bookkeeping."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Remove columns; names that are not there are ignored."""
    return df.drop(*cols)


def rename_by_regex(df: DataFrame, pattern: str, new: str) -> DataFrame:
    """Replace what ``pattern`` matches in a column name by ``new`` (``\\1`` refers to a group)."""
    return df.toDF(*(re.sub(pattern, new, name, count=1) for name in df.columns))
