"""Every registered query against its DuckDB oracle on the sf0.001 tables, plus the entry."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import TABLES, digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402

from conftest import SF001  # noqa: E402

from tidewater.plans import registry  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    """But those that the training-data subpackage names as not to be said in SQL."""
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert E.without_sql() <= set(E.queries()) - set(registry.queries())
    assert set(E.queries()) - E.without_sql() == set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [c[0] for c in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(exp)
    assert digest(df.columns, got)[0] == digest(ocols, exp)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "source_city", "inspections", "pass_rate_pct"]
    assert df.count() > 0
