"""Every query with SQL gives what DuckDB gives; the others run and give rows."""

import datetime
import decimal

import duckdb
import pytest

from pagemill import queries as engine

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(engine.oracle_sql()))
def test_sql(spark, sf_dir, duck, name):
    df = engine.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck.execute(engine.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(engine.queries()) - set(engine.oracle_sql())))
def test_rows(spark, sf_dir, name):
    assert engine.queries()[name](spark, sf_dir).limit(5).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 50
    assert set(e.oracle_sql()) <= set(e.queries())
