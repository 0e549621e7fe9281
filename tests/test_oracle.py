"""Every registered key against its DuckDB oracle on sf0.001 (the driver's gate runs sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from lakecart.plans.oracle import oracle_sql as lakehouse_oracle
from lakecart.plans.queries import queries as lakehouse_queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KEYS = sorted(lakehouse_queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def test_every_key_has_oracle():
    assert set(lakehouse_oracle()) == set(KEYS)
    assert set(KEYS) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, srows) == canon(ocols, cur.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
