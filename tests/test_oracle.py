"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle(data):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return connection


def _sorted(rows):
    def plain(value):
        return round(value, 9) if isinstance(value, float) else value

    rows = [tuple(plain(v) for v in row) for row in rows]
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


@pytest.mark.parametrize("name", sorted(set(contract.queries()) & set(contract.QUERIES)))
def test_query_matches_sql(spark, data, oracle, name):
    df = contract.queries()[name](spark, data)
    columns = sorted(df.columns)
    rows = [[r[c] for c in columns] for r in df.collect()]
    assert name in contract.oracle_sql(), f"{name} has no SQL counterpart"
    result = oracle.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [[row[names.index(c)] for c in columns] for row in result.fetchall()]
    assert _sorted(rows) == _sorted(expected)


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
