"""The document queries that SQL can express, on a second engine."""

import duckdb
import pytest

import __spark_entry__ as contract
from llm_helpers import SF
from tidegrid.llm import oracles, queries


@pytest.mark.parametrize("name", oracles.ORACLES)
def test_query_equals_its_sql(spark, name):
    assert contract.oracle_sql()[name] is oracles.ORACLES[name]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = con.execute(oracles.ORACLES[name]).df()
    found = queries.QUERIES[name](spark, SF).toPandas()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)

    def in_order(df):
        return df[columns].astype(str).sort_values(columns).reset_index(drop=True)
    assert in_order(found).equals(in_order(expected)) and len(found) > 0
