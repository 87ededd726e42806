"""Every named query against its SQL on the smallest tables."""

import pathlib
import subprocess
import sys

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, database, name):
    frame = queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    ours = rows_of([[r[c] for c in columns] for r in frame.collect()])
    if name not in STATEMENTS:
        assert ours
        return
    result = database.execute(STATEMENTS[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert ours == rows_of([[r[i] for i in at] for r in result.fetchall()])


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["category", "prefecture", "sales_amount"] and result.count() > 0


def test_catalogue_needs_no_session():
    """The list of queries and their SQL can be read before any session exists."""
    root = pathlib.Path(__file__).parent.parent
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == [str(len(queries())), str(len(STATEMENTS))]
