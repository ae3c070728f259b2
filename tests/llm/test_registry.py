"""Every corpus query with SQL gives the same rows as DuckDB, on the smallest tables."""

import duckdb
import pytest

from lakewright.llm import registry
from tests.conftest import SMALL
from tests.test_queries import TABLES, _sorted


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SMALL)
    wanted = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in wanted.description]
    assert sorted(names) == sorted(got.columns)
    assert _sorted(got.columns, got.collect()) == _sorted(names, wanted.fetchall())


def test_names_are_numbered():
    assert [int(n[2:].split("_")[0]) for n in registry.QUERIES] == list(range(1, 14))
