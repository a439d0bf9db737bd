"""The queries that SQL can express, value by value."""

import duckdb
import pytest

from tallywatch.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = connection.sql(ORACLES[name])
    result = QUERIES[name](spark, sf_dir)
    assert sorted(result.columns) == sorted(expected.columns)
    want = sorted(expected.project(", ".join(result.columns)).fetchall())
    assert sorted(tuple(r) for r in result.collect()) == want


def test_every_operator_has_a_query():
    assert [sum(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 14)] == [1] * 13
