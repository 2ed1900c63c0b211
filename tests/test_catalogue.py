"""Queries against their DuckDB twins on whole generated tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from crewgrid.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query_equals_its_sql(spark, db, name):
    got = catalogue.queries()[name](spark, SF)
    want = db.sql(catalogue.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), want.columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())
