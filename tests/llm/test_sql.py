"""Queries of this subpackage that SQL can express, against DuckDB."""

import duckdb
import pytest

pytest.importorskip("brindle.llm")

from brindle.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df, rel = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    own = {c: k for k, c in enumerate(df.columns)}
    assert sorted(tuple(r[own[c]] for c in rel.columns) for r in df.collect()) == sorted(rel.fetchall())
