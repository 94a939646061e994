"""Registered corpus queries, and the one that SQL can express against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.llm import catalog

SF = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = E.queries()
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(catalog.oracle_sql()) <= set(names)


@pytest.mark.parametrize("key", sorted(catalog.oracle_sql()))
def test_oracle(spark, key):
    con = duckdb.connect()
    for name in ("pages", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    rel = con.sql(catalog.oracle_sql()[key])
    df = catalog.queries()[key](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(tuple, df.select(*rel.columns).collect())) == sorted(rel.fetchall())
