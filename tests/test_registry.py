"""Every registered query against its SQL, on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from workload import oracle, registry  # noqa: E402

# The optional operators have tests of their own.
QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_which_queries_have_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, db, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    result = db.execute(ORACLE[key])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert check.rows(df.columns, df.collect()) == check.rows(names, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["day", "active_users", "sessions"]
