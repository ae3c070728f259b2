"""Every query with SQL gives the same rows as DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from lakewright import catalog
from tests.conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def _value(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def _sorted(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SMALL)
    wanted = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in wanted.description]
    assert sorted(df.columns) == sorted(names)
    assert _sorted(df.columns, [tuple(r) for r in df.collect()]) == _sorted(names, wanted.fetchall())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
