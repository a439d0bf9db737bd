"""Every query against its SQL, value by value."""

import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from tallywatch.queries.catalog import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}

@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def as_rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(
        (tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)), key=repr
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, database, name):
    result = entry_module.queries()[name](spark, sf_dir)
    expected = database.sql(entry_module.oracle_sql()[name])
    want = {column: str(kind) for column, kind in zip(expected.columns, expected.types)}
    assert {column: TYPES[kind] for column, kind in result.dtypes} == want
    assert as_rows(result.toPandas()) == as_rows(expected.df())


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_oracles_do_not_cut_the_tables_down():
    limited = {name for name, text in ORACLES.items() if re.search(r"\bLIMIT\b|\bSAMPLE\b", text)}
    assert limited == {"extract_limited", "recent_anomalies"}


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
