"""Every registered query against its SQL on a second engine."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_an_oracle():
    assert contract.QUERIES.keys() == contract.ORACLES.keys()
    assert contract.queries().keys() >= contract.oracle_sql().keys() >= contract.ORACLES.keys()


@pytest.mark.parametrize("name", contract.QUERIES)
def test_query(spark, duck, name):
    found = contract.queries()[name](spark, SF).toPandas()
    expected = duck.execute(contract.oracle_sql()[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)

    def in_order(df):
        return df[columns].astype(str).sort_values(columns).reset_index(drop=True)

    assert in_order(found).equals(in_order(expected))
    assert len(found) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
