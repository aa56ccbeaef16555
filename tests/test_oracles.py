"""Every registered query against its SQL on the smallest tables."""

import decimal
import math

import pytest

import __spark_entry__ as entry_module

duckdb = pytest.importorskip("duckdb")

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    done = duck.execute(ORACLES[name])
    names = [d[0] for d in done.description]
    assert sorted(names) == sorted(df.columns)
    assert table(df.columns, df.collect()) == table(names, done.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, small, name):
    assert QUERIES[name](spark, small).count() >= 0


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
