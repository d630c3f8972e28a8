"""Summaries over targets and over score columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import finite, rounded
from ..functions.session import saved
from . import ranges

#: Resamples that a task is given, and places that it draws at once (one resample at least).
REPS, DRAWN = 100, 1 << 20


def long_metrics(df: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("target_id",)) -> DataFrame:
    """(keys, metric, value) rows of finite values."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    out = df.select(*keys, F.explode(pairs).alias("_x")).select(*keys, "_x.metric", finite(F.col("_x.value")).alias("value"))
    return out.filter("value is not null")


def five_numbers(long: DataFrame, by: Sequence[str] = ("metric",)) -> DataFrame:
    """n, mean, median and quartiles of ``value`` per group, of any size; quartiles interpolate.

    They are taken as whole multiples of 1e-11 before they are rounded to 6 digits, so that what lies half way
    between two results goes to the even one, however the last bits of the interpolation came out.
    """
    even = lambda c: F.rint(F.rint(F.col(c) * F.lit(10.0**11)) / F.lit(10.0**5)) / F.lit(10.0**6)
    long = saved(long.select(*by, "value"), "long-values")
    found = ranges.quantiles(long, "value", by, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    means = long.groupBy(*by).agg(F.avg("value").alias("_mean"))
    return ranges._join(found, means, by).select(*by, "n", even("_mean").alias("mean"), *[even(c).alias(c) for c in ("q1", "median", "q3")])


def draws(seed: int, reps: np.ndarray, n: int) -> np.ndarray:
    """Places below ``n``, ``n`` for each resample, from whole-number arithmetic modulo 2**31 - 1: the same
    in any engine."""
    p = 2**31 - 1
    x = (seed * 1_000_003 + reps.astype(np.int64)[:, None] * 65_599 + np.arange(n, dtype=np.int64)[None] * 48_271 + 1) % p
    for add in (11, 1013, 104_729):
        x = (x * x % p + x * 16_807 + add) % p
    return x % n


def bootstrap_median(long: DataFrame, *, reps: int = 2000, seed: int = 42, key: str = "target_id") -> DataFrame:
    """(metric, low, high): 95% interval of the median over resamples.

    Draw i of a resample is the value at the place that ``draws`` gives for (seed, resample, i).  The
    values of a metric, one per key, are one array; tasks share out the resamples, so no draw is
    shuffled.
    """
    values = long.groupBy("metric").agg(F.transform(F.array_sort(F.collect_list(F.struct(key, "value"))), lambda x: x["value"]).alias("_v"))
    each = values.select("metric", "_v", F.explode(F.sequence(F.lit(1), F.lit(reps), F.lit(REPS))).alias("_first")).repartition("metric", "_first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for metric, first, v in zip(b.column("metric").to_pylist(), b.column("_first").to_pylist(), b.column("_v")):
                v = v.values.to_numpy()
                mine = np.arange(first, min(first + REPS, reps + 1))
                some = max(1, DRAWN // len(v))
                m = np.concatenate([np.median(v[draws(seed, mine[i : i + some], len(v))], axis=1) for i in range(0, len(mine), some)])
                yield pa.RecordBatch.from_arrays([pa.array([metric] * len(m)), pa.array(m)], ["metric", "m"])

    medians = each.mapInArrow(run, "metric string, m double")
    q = F.percentile("m", F.array(F.lit(0.025), F.lit(0.975)))
    return medians.groupBy("metric").agg(q.alias("_q")).select("metric", rounded(F.col("_q")[0], 6).alias("low"), rounded(F.col("_q")[1], 6).alias("high"))


def upper_median(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """The value at place n div 2 from 0, with least and largest."""
    return ranges.at_places(df, value, by, lambda n: [F.floor(n / 2), F.lit(0), n - 1], ["upper_median", "least", "largest"])


def medians(df: DataFrame, values: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, n, values): the number of rows of each group and the exact median of each column."""
    df = saved(df.select(*by, *values), "columns")
    found = ranges.quantiles(long_metrics(df, values, by), "value", [*by, "metric"], {"m": 0.5})
    found = found.groupBy(*by).agg(*[F.max(F.when(F.col("metric") == v, F.col("m"))).alias(v) for v in values])
    return ranges._join(df.groupBy(*by).agg(F.count("*").alias("n")), found, by)


def threshold_shares(df: DataFrame, value: str, limits: Sequence[float], below: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    cols = [rounded(F.avg((F.col(value) >= x).cast("double")), 6).alias(f"share_{int(x * 100)}") for x in limits]
    return df.groupBy(*by).agg(F.count("*").alias("n"), *cols, rounded(F.avg((F.col(value) < below).cast("double")), 6).alias("share_reversed"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """(bin, n): equal bins over 0 to 1, the last one closed; empty bins have 0."""
    b = F.least(F.lit(bins - 1), F.floor(F.col(value) * bins)).cast("int")
    counts = df.filter(F.col(value).between(0, 1)).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def bucket(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges that are at most the value."""
    out = F.lit(0)
    for e in edges:
        out = out + (value >= e).cast("int")
    return out


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str]) -> DataFrame:
    """Correlation of finite pairs; NULL for fewer than three."""
    rows = df.filter(finite(F.col(x)).isNotNull() & finite(F.col(y)).isNotNull())
    return rows.groupBy(*by).agg(F.count("*").alias("n"), rounded(F.when(F.count("*") >= 3, F.corr(x, y)), 6).alias("correlation"))


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str]) -> DataFrame:
    """Correlation of ranks within groups of any size; ties share the mean of their places."""
    df = saved(df.select(*by, x, y), "pairs")
    ranked = ranges.average_ranks(ranges.average_ranks(df, x, by, "_rx"), y, by, "_ry")
    return pearson(ranked, "_rx", "_ry", by)


def funnel(df: DataFrame, *, l1: float = 0.45, l2_part: float = 0.10, l3: float = 0.5, positive: Column) -> DataFrame:
    """Per target: what each step of the cascade keeps, of rows and of positives."""
    w = W.partitionBy("target_id")
    rows = df.withColumn("_s1", F.col("l1") >= l1)
    rows = rows.withColumn("_n1", F.count_if("_s1").over(w)).withColumn("_r", F.row_number().over(w.orderBy(F.col("_s1").desc(), F.col("l2").desc(), "candidate_index")))
    second = F.col("_s1") & (F.col("_r") <= F.greatest(F.lit(1), F.rint(F.col("_n1") * l2_part)))
    third = F.col("l3") >= l3
    share = lambda c: F.when(F.count_if(positive) > 0, rounded(F.count_if(positive & c) / F.count_if(positive), 3))
    return rows.groupBy("target_id").agg(
        rounded(F.avg(F.col("_s1").cast("double")), 3).alias("l1_keep"), share(F.col("_s1")).alias("l1_positives"), share(second).alias("l2_positives"),
        rounded(F.avg(third.cast("double")), 3).alias("l3_keep"), share(third).alias("l3_positives"),
    )


def listwise_loss(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """(target_id, loss): minus the mean over positives of score less log-sum-exp over the pool."""
    w = W.partitionBy("target_id")
    rows = df.withColumn("_top", F.max(score).over(w))
    agg = rows.groupBy("target_id").agg(F.max("_top").alias("t"), F.sum(F.exp(F.col(score) - F.col("_top"))).alias("e"), F.avg(F.when(positive, F.col(score))).alias("p"))
    return agg.select("target_id", rounded(F.col("t") + F.log("e") - F.col("p"), 6).alias("loss"))


def pairwise_loss(pairs: DataFrame, better: str, worse: str, by: Sequence[str] = ("target_id",)) -> DataFrame:
    """Mean logistic loss of score differences."""
    return pairs.groupBy(*by).agg(F.count("*").alias("n_pairs"), rounded(F.avg(F.log1p(F.exp(F.col(worse) - F.col(better)))), 6).alias("loss"))
