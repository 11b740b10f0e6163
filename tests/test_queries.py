"""Every registered query against its SQL in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
LLM = set(entry.llm.queries()) if entry.llm else set()  # tested in tests/llm
ORACLES = entry.oracle_sql()
QUERIES = {name: query for name, query in entry.queries().items() if name not in LLM}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def canonical(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    table = [tuple(plain(r[i]) for i in order) for r in tuples]
    return sorted(names), sorted(table, key=lambda r: tuple((v is not None, str(type(v)), v or 0) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) - LLM


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    want = canonical([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() == 10
