"""Every registered query of the genomic operators against its SQL in DuckDB, at the smallest size."""

import math
import os

import duckdb
import pytest

from flankspark.jobs import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, int | float):
        return round(float(value), 9) + 0.0
    return str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    key = lambda rows, own: sorted((tuple(plain(r[own.index(c)]) for c in columns) for r in rows), key=repr)
    assert key([tuple(r) for r in got.collect()], got.columns) == key(want.fetchall(), names)


def test_every_query_reads_given_tables(spark):
    from flankspark.jobs.exchange import NO_SQL

    assert set(QUERIES) - NO_SQL == set(ORACLES)
