"""Every query with SQL gives what DuckDB gives for it, on the small tables."""

import math

import duckdb
import pytest

from quillon.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return str(v) if v is not None and not isinstance(v, (int, bool)) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr([norm(x) for x in r]) for r in df.select(*cols).collect())
    found = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted(repr([norm(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i]) for i in at]) for r in found.fetchall())
    assert got == want


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
