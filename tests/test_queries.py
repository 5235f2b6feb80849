"""Each query of the engine against its SQL, run by DuckDB on the same tables."""

import duckdb
import pytest

from folioforge import multi_queries, project_queries, queries, schema_queries  # noqa: F401
from folioforge import registry as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", own.QUERIES)
def test_equals_sql(spark, sf, duck, name):
    df = own.QUERIES[name](spark, sf)
    got = df.toArrow().to_pylist()
    result = duck.execute(own.ORACLES[name])
    names = [d[0] for d in result.description]
    want = [dict(zip(names, r, strict=True)) for r in result.fetchall()]
    assert sorted(df.columns) == sorted(names)
    key = lambda r: repr([r[c] for c in sorted(names)])
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert got
