"""The registered queries, on the smallest tables, against their SQL twins."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
import check

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name in ORACLES:
        assert check.compare(got, con.execute(ORACLES[name]).df()) == ""


def test_entry(spark, sf_dir):
    assert contract.entry(spark).count() > 0
