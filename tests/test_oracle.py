"""Every registered query against its SQL in another engine, exactly, on the small data."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import TESTDATA

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("lineitem", "orders", "customer"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return connection


def canonical(rows):
    return sorted((tuple(repr(v + 0.0) if isinstance(v, float) else str(v) for v in row) for row in rows))


def test_every_query_has_sql():
    assert set(entry.REGISTERED) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(entry.REGISTERED))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, TESTDATA)
    cursor = duck.execute(ORACLES[name])
    found = {c[0]: (i, str(c[1])) for i, c in enumerate(cursor.description)}
    columns = sorted(df.columns)
    assert columns == sorted(found)
    assert {c: TYPES[t] for c, t in df.dtypes} == {c: found[c][1] for c in columns}
    expected = [[row[found[c][0]] for c in columns] for row in cursor.fetchall()]
    assert canonical(df.select(*columns).collect()) == canonical(expected)
    # The report's key contract holds, so its check finds nothing.
    assert bool(expected) == (name != "duplicate_report_keys")


def test_entry_runs(spark):
    assert entry.entry(spark).columns == entry._snap_report(entry.League(spark, TESTDATA)).columns
