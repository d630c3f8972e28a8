"""Ranks and order statistics of large groups by ranges of their values.

Rows are counted by group and distinct value first.  A sketch of the values of each large group gives the edges of
ranges; running counts are taken over ranges, and within a range over its values, so no task sorts a large group.
A group of few values is one range.
Order statistics look into the ranges that hold a wanted place only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.session import saved

#: Ranges of a group, and the accuracy of the sketch that gives their edges.
RANGES, ACCURACY = 200, 2000
#: Distinct values that a range has in any case, and edges that are looked through at once.
RANGE_VALUES, STRIDE = 10_000, 14


def _before(w) -> Column:
    return F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def ranged(df: DataFrame, value: str, by: Sequence[str], keep: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """(values, ranges): (by, _v, _n, _range) for each distinct value, and (by, _range, _n, _first) with the number of
    rows before each range.  Null and NaN values are left out."""
    kept = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    per = saved(kept.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n")), "distinct-values")
    large = per.groupBy(*by).agg(F.count("*").alias("_values")).filter(F.col("_values") > RANGE_VALUES)
    large = saved(large, "large-groups")  # one row in RANGE_VALUES at most
    if large.isEmpty():
        per = per.withColumn("_range", F.lit(0))
    else:
        found = _join(per, large.drop("_values"), by) if by else per
        edges = found.groupBy(*by).agg(F.percentile_approx("_v", [i / RANGES for i in range(1, RANGES)], ACCURACY).alias("_edges"))
        below = lambda c: F.size(F.filter(c, lambda x: x < F.col("_v")))
        per = _join(per, edges, by, "left").withColumn("_first", STRIDE * below(F.array(*[F.col("_edges")[i] for i in range(STRIDE - 1, RANGES - 1, STRIDE)])))
        within = F.slice("_edges", F.col("_first") + 1, F.lit(STRIDE))
        per = per.withColumn("_range", F.when(F.col("_edges").isNull(), 0).otherwise(F.col("_first") + below(within))).drop("_edges", "_first")
    counts = per.groupBy(*by, "_range").agg(F.sum("_n").alias("_n"))
    return per, counts.withColumn("_first", _before(W.partitionBy(*by or [F.lit(0)]).orderBy("_range")))  # a row per range


def _join(a: DataFrame, b: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Null groups are groups too."""
    if not by:
        return a.crossJoin(F.broadcast(b))  # one row
    right = b.select(*[F.col(c).alias(f"_by_{c}") if c in by else F.col(c) for c in b.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return a.join(right, on, how).drop(*[f"_by_{c}" for c in by])


def average_ranks(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """``df`` with the rank of ``value`` within its group from 1 on; equal values share the mean of their places.

    Rows without a value have no rank.
    """
    per, ranges = ranged(df, value, by)
    within = per.withColumn("_within", _before(W.partitionBy(*by, "_range").orderBy("_v")))
    ranks = _join(within, ranges.drop("_n"), [*by, "_range"]).select(*by, "_v", (F.col("_first") + F.col("_within") + (F.col("_n") + 1) / 2.0).alias(name))
    right = ranks.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_v", name)
    on = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return df.join(right, [*on, F.col(value).cast("double") == F.col("_v")], "left").drop("_v", *[f"_by_{c}" for c in by])


def at_places(df: DataFrame, value: str, by: Sequence[str], places: Callable[[Column], Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """(by, n, names): the values at wanted places, from 0 on, of each group in order.

    ``places`` gives them for a group's number of rows.
    """
    per, ranges = ranged(df, value, by)
    sizes = ranges.groupBy(*by).agg(F.sum("_n").alias("n"))
    wanted = sizes.select(*by, "n", F.posexplode(F.array(*[p.cast("long") for p in places(F.col("n"))])).alias("_i", "_place"))
    here = _join(wanted, ranges, by).filter((F.col("_place") >= F.col("_first")) & (F.col("_place") < F.col("_first") + F.col("_n")))
    looked = here.groupBy(*by, "n", "_range", "_first").agg(F.collect_list(F.struct("_i", (F.col("_place") - F.col("_first")).alias("_at"))).alias("_wanted"))  # as many as names
    inside = _join(per, looked, [*by, "_range"])
    inside = inside.withColumn("_within", _before(W.partitionBy(*by, "_range").orderBy("_v")))
    hits = inside.select(*by, "n", "_v", "_n", "_within", F.explode("_wanted").alias("_w")).filter((F.col("_w._at") >= F.col("_within")) & (F.col("_w._at") < F.col("_within") + F.col("_n")))
    return hits.groupBy(*by, "n").agg(*[F.max(F.when(F.col("_w._i") == i, F.col("_v"))).alias(name) for i, name in enumerate(names)])


def quantiles(df: DataFrame, value: str, by: Sequence[str], parts: dict[str, float]) -> DataFrame:
    """(by, n, one column for each of ``parts``): exact quantiles that interpolate between neighbours."""
    place = lambda n, q: (n - 1) * F.lit(q)
    names = [f"_{x}{i}" for i in range(len(parts)) for x in ("low", "high")]
    found = at_places(df, value, by, lambda n: [f(place(n, q)) for q in parts.values() for f in (F.floor, F.ceil)], names)
    n = F.col("n")
    value_at = lambda i, q: F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * (place(n, q) - F.floor(place(n, q)))
    return found.select(*by, "n", *[value_at(i, q).alias(name) for i, (name, q) in enumerate(parts.items())])
