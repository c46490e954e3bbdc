"""Every registered query against its SQL twin, over the whole tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from meterflow.plans.catalog import QUERIES
from meterflow.plans.oracle import ORACLE

SF_DIR = os.environ.get("METERFLOW_TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("customer", "events", "nation", "orders")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(columns, rows):
    """Rows as text with the columns in name order, in any row order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return str(value)

    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    actual = canonical(df.columns, df.collect())
    relation = duck.execute(oracle_sql()[name])
    expected = canonical([d[0] for d in relation.description], relation.fetchall())
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert len(actual[1]) > 0
    assert actual[1] == expected[1]
