"""Sinks.  Tables that others read while they are replaced are in ``published``: these appear as a whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import rounded
from ..operators.audit import canonical
from ..operators.ranking import top_n


def table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def scores_by_target(df: DataFrame, path: str, key: str = "target_id", rows_per_file: int = 5_000_000) -> None:
    """One folder per target; only the targets in ``df`` are replaced.

    Rows are dealt by target and a salt, so that a large target isn't written by one task.
    """
    salted = df.repartition(F.col(key), F.pmod(F.xxhash64(*df.columns), F.lit(8)))
    salted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy(key).parquet(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def reranked(df: DataFrame, path: str, rank: str = "dock_rank") -> None:
    """Rows that have a rank, in its order."""
    csv(df.filter(F.col(rank).isNotNull()).orderBy(rank), path)


def summary(df: DataFrame, path: str) -> None:
    """Canonical JSON rows with their digests."""
    canonical(df).write.mode("overwrite").json(path)


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def top_hits(df: DataFrame, path: str, score: str = "final_score", key: str = "candidate_index", n: int = 20, targets: int | None = None) -> None:
    """The best rows of each target as one JSON row per target; of the first ``targets`` targets by id, if that is given."""
    if targets is not None:
        df = df.join(F.broadcast(df.select("target_id").distinct().orderBy("target_id").limit(targets)), "target_id", "left_semi")
    best = top_n(df, score, n).groupBy("target_id").agg(F.sort_array(F.collect_list(F.struct("rank", F.col(key).alias("key"), rounded(F.col(score), 4).alias("score")))).alias("hits"))
    best.write.mode("overwrite").json(path)


def report(summary_rows: DataFrame, statuses: DataFrame) -> DataFrame:
    """(section, metric, value): a summary and status counts as one long table."""
    cols = [c for c, t in summary_rows.dtypes if c != "metric" and t in ("double", "bigint", "int")]
    a = summary_rows.select(F.concat(F.lit("metric:"), "metric").alias("section"), F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])).alias("_x"))
    b = statuses.select(F.lit("status").alias("section"), F.col("docking_status").alias("metric"), F.col("n").cast("double").alias("value"))
    return a.select("section", "_x.metric", "_x.value").unionByName(b)
