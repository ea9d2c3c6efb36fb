"""Every query that SQL expresses, against that SQL."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__


@pytest.fixture(scope="module")
def tables(data):
    connection = duckdb.connect()
    for path in Path(data).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)) or str(x) in ("<NA>", "NaT"):
        return ""
    try:
        return f"{float(x):.6f}"
    except (TypeError, ValueError):
        return str(x)


def rows(frame):
    frame = frame.reindex(sorted(frame.columns), axis=1)
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_equals_sql(spark, data, tables, name):
    found, wanted = __spark_entry__.queries()[name](spark, data).toPandas(), tables.execute(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns) and rows(found) == rows(wanted)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
