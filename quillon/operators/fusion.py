"""Second-stage evidence: selection, merge, and fusion with the base score.

Spread of the base is taken over the whole pool and the z-score over rows with evidence, both in the
population form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import ligand_efficiency

EPS = 1e-9


def screened(results: DataFrame, most_atoms: int) -> DataFrame:
    """``status`` before any costly step: rows without atoms are invalid, large ones are skipped."""
    n = F.col("heavy_atoms")
    return results.withColumn("status", F.when(n.isNull(), "invalid").when(n > most_atoms, "skipped_size").otherwise(F.col("status")))


def ranking_score(df: DataFrame, fused: str = "fused_score", base: str = "final_score") -> DataFrame:
    """``df`` with ``ranking_score``: the fused column if it is there and has any value, else the base."""
    if fused not in df.columns:
        return df.withColumn("ranking_score", F.col(base))
    some = df.agg(F.coalesce(F.bool_or(F.col(fused).isNotNull()), F.lit(False)).alias("_any"))  # one row
    return df.crossJoin(F.broadcast(some)).withColumn("ranking_score", F.when(F.col("_any"), F.col(fused)).otherwise(F.col(base))).drop("_any")


def attach(scores: DataFrame, results: DataFrame, keys: Sequence[str] = ("target_id", "candidate_index")) -> DataFrame:
    """Scores with status, affinity and efficiency; only successful rows have an efficiency."""
    ok = F.col("status") == "ok"
    r = results.select(
        *keys, F.col("status").alias("_st"), F.when(ok, F.col("affinity")).alias("docking_affinity"), F.when(ok, ligand_efficiency(F.col("affinity"), F.col("heavy_atoms"))).alias("ligand_efficiency")
    )
    out = scores.join(r, list(keys), "left")
    return out.withColumn("docking_status", F.coalesce("_st", F.lit("not_selected"))).drop("_st")


def z(x: Column, by: Sequence[str]) -> Column:
    """z-score over the rows where ``x`` isn't NULL."""
    w = W.partitionBy(*by)
    return (x - F.avg(x).over(w)) / (F.stddev_pop(x).over(w) + F.lit(EPS))


def le_norm(le: Column, by: Sequence[str]) -> Column:
    """1 for the best (lowest) efficiency, 0 for the worst; 0 where missing or if all are equal."""
    w = W.partitionBy(*by)
    lo, hi = F.min(le).over(w), F.max(le).over(w)
    return F.when(le.isNotNull() & (hi > lo), F.rint((hi - le) / (hi - lo) * 10000.0) / 10000.0).otherwise(0.0)


def corrected(base: str, le: str, *, weight: float = 0.30, by: Sequence[str] = ("target_id",)) -> Column:
    """base + weight * spread(base) * z(-le) for rows with evidence; the base itself for others."""
    spread = F.stddev_pop(F.col(base)).over(W.partitionBy(*by)) + F.lit(EPS)
    return F.when(F.col(le).isNotNull(), F.col(base) + F.lit(weight) * spread * z(-F.col(le), by)).otherwise(F.col(base))


def rank_sum(first: str, second: str, *, by: Sequence[str] = ("target_id",), tie: str = "candidate_index") -> Column:
    """Minus the sum of two descending ranks."""
    rank = lambda c: F.row_number().over(W.partitionBy(*by).orderBy(F.col(c).desc_nulls_last(), tie))
    return -(rank(first) + rank(second))


def z_sum(base: str, le: str, by: Sequence[str] = ("target_id",)) -> Column:
    """z(base) + z(-le), where missing evidence counts as 0."""
    return z(F.col(base), by) + z(-F.coalesce(F.col(le), F.lit(0.0)), by)


def eliminated(le: str) -> Column:
    """-le, and far below everything without evidence: the baseline that breaks the order of the rest."""
    return F.coalesce(-F.col(le), F.lit(-1e9))
