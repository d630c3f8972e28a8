"""Queries and their SQL state one rule where small tables don't show it."""

import random
from decimal import ROUND_HALF_EVEN, Decimal

import duckdb
from quillon.operators import stats
from quillon.plans import catalog


def test_more_rows_than_the_limit(spark, tmp_path):
    duckdb.sql(f"COPY (SELECT i AS p_partkey, 'n' || i AS p_name, 't' AS p_type FROM range(100001) t(i)) TO '{tmp_path}/part.parquet'")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    want = con.execute(catalog.ORACLES["candidate_summary"])
    names, row = [d[0] for d in want.description], want.fetchone()
    assert catalog.QUERIES["candidate_summary"](spark, str(tmp_path)).first().asDict() == dict(zip(names, row))
    assert dict(zip(names, row))["error"] == "rows:too_many"


def test_tables_in_folders_of_files(spark, tmp_path):
    for name in ("nation", "region", "supplier", "part"):
        spark.range(10).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {tuple(r) for r in catalog.QUERIES["file_manifest"](spark, str(tmp_path)).collect()}
    assert got == set(duckdb.sql(catalog.ORACLES["file_manifest"]).fetchall())


def test_ties_of_summaries_go_to_the_even_digit(spark):
    rng, rows, want = random.Random(3), [], {}
    for g in range(400):
        a = rng.randrange(400_000, 600_000)
        pair = [a, a + rng.choice([1, 2, 3, 5, 6])]
        rows += [(g, x / 10**6) for x in pair]
        at = lambda q: (Decimal(pair[0]) + (pair[1] - pair[0]) * Decimal(q)).quantize(Decimal(1), ROUND_HALF_EVEN)  # noqa: B023, E731
        want[g] = tuple(float(at(q) / 10**6) for q in ("0.25", "0.5", "0.75"))
    got = stats.five_numbers(spark.createDataFrame(rows, "g int, value double"), ["g"]).collect()
    assert {r["g"]: (r["q1"], r["median"], r["q3"]) for r in got} == want
