"""Every query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from kinelake.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def plain(v):
    return v if v is None else ("nan" if math.isnan(v) else repr(round(v, 9) + 0.0)) if isinstance(v, float) else str(v)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_equals_sql(spark, duck, name):
    got, sql = catalogue.QUERIES[name](spark, SF), duck.sql(catalogue.ORACLES[name])
    assert sorted(got.columns) == sorted(sql.columns)
    assert rows(got.columns, got.collect()) == rows(sql.columns, sql.fetchall())


def test_entry_module():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
