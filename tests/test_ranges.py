import random

import numpy as np
from pyspark.sql import functions as F
from quillon.operators import ranges, stats


def made(spark, n=4000):
    rng = random.Random(4)
    value = lambda: rng.choice([None, float("nan"), 0.5, 0.5, -1.0, rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)])
    rows = [("all" if i % 10 else rng.choice(["few", None]), value(), value()) for i in range(n)] + [("one", 3.0, 1.0), ("none", None, 1.0)]
    return rows, spark.createDataFrame(rows, "g string, x double, y double").repartition(7)


def clean(rows, g):
    return sorted(x for k, x, _ in rows if k == g and x is not None and not np.isnan(x))


def test_quantiles_and_places_of_large_groups(spark):
    rows, df = made(spark)
    got = {r["g"]: r for r in ranges.quantiles(df, "x", ["g"], {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.975, "e": 1.0}).collect()}
    assert set(got) == {"all", "few", None, "one"}
    for g, r in got.items():
        x = clean(rows, g)
        assert r["n"] == len(x) and np.allclose([r[c] for c in "abcde"], np.quantile(x, [0, 0.1, 0.5, 0.975, 1]))
    up = {r["g"]: r for r in stats.upper_median(df, "x", ["g"]).collect()}
    assert all((r["upper_median"], r["least"], r["largest"]) == (clean(rows, g)[len(clean(rows, g)) // 2], clean(rows, g)[0], clean(rows, g)[-1]) for g, r in up.items())
    whole = ranges.quantiles(df, "x", [], {"m": 0.5}).first()
    assert np.isclose(whole["m"], np.median([x for _, x, _ in rows if x is not None and not np.isnan(x)]))
    assert ranges.quantiles(df.limit(0), "x", ["g"], {"m": 0.5}).count() == 0


def test_ranks_share_ties(spark):
    rows, df = made(spark)
    out = ranges.average_ranks(df, "x", ["g"], "r").collect()
    assert len(out) == len(rows)
    for g in ("all", "few", None):
        x = clean(rows, g)
        for r in out:
            if r["g"] == g and r["x"] is not None and not np.isnan(r["x"]):
                assert r["r"] == np.searchsorted(x, r["x"]) + (np.searchsorted(x, r["x"], "right") - np.searchsorted(x, r["x"]) + 1) / 2
    assert all(r["r"] is None for r in out if r["x"] is None or np.isnan(r["x"]))


def test_no_range_holds_much_of_a_group(spark):
    df = spark.range(50_000).select(F.lit("g").alias("g"), (F.xxhash64("id") / 2.0**63).alias("x"))
    _, found = ranges.ranged(df, "x", ["g"])
    assert found.count() == ranges.RANGES and found.agg(F.max("_n")).first()[0] < 3 * 50_000 / ranges.RANGES


def test_a_group_of_few_values_is_one_range(spark, monkeypatch):
    """Each group had a sketch, and each value was held against all edges."""
    _, df = made(spark)
    assert {r["g"]: r["n"] for r in ranges.ranged(df, "x", ["g"])[1].groupBy("g").agg(F.count("*").alias("n")).collect()} == {"all": 1, "few": 1, None: 1, "one": 1}
    monkeypatch.setattr(ranges, "RANGE_VALUES", 300)
    mixed = {r["g"]: r["n"] for r in ranges.ranged(df, "x", ["g"])[1].groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert mixed.pop("all") > 150 and mixed == {"few": 1, None: 1, "one": 1}
    test_quantiles_and_places_of_large_groups(spark)
    test_ranks_share_ties(spark)
