"""Every registered query that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest

from brindle.plans import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(round(r[i], 9) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, duck, name):
    df, rel = queries.QUERIES[name](spark, SF), duck.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.collect(), df.columns) == canon(rel.fetchall(), rel.columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
