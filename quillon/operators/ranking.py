"""Ranks, top lists and ranking metrics, grouped by target.

Windows are partitioned by target.  Metrics that share ties first reduce a target to its distinct
scores (rows and positives per score), so the windows after it see one row per score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import finite, rounded, top_count
from . import ranges

#: Ranges of scores in a ranking of a whole table.
RANGES = 256
POSITIVE, NEGATIVE, BACKGROUND = "heldout_positive", "heldout_negative", "unlabeled_background"


def is_positive(role: str = "label_role") -> Column:
    return F.col(role) == POSITIVE


def stable_rank(df: DataFrame, score: str, *, by: Sequence[str] = ("target_id",), tie: Sequence[str] = ("candidate_index",), name: str = "rank") -> DataFrame:
    """Rank from 1, best score first, missing and non-finite scores last, ties by ``tie``."""
    order = [finite(F.col(score)).desc_nulls_last(), *[F.col(t) for t in tie]]
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def top_n(df: DataFrame, score: str, n: int, **kw) -> DataFrame:
    """Best ``n`` rows per target with their rank; none for n <= 0."""
    return stable_rank(df, score, **kw).filter(F.col(kw.get("name", "rank")) <= n)


def score_groups(df: DataFrame, score: str, *, by: Sequence[str] = ("target_id",), positive: Column | None = None) -> DataFrame:
    """One row per target and distinct score: rows, positives, and rows before it (best first)."""
    p = is_positive() if positive is None else positive
    value = finite(F.col(score))
    groups = df.filter(value.isNotNull()).groupBy(*by, value.alias("score")).agg(F.count("*").alias("n"), F.count_if(p).alias("p"))
    w = W.partitionBy(*by)
    return groups.select(
        *by, "score", "n", "p",
        F.coalesce(F.sum("n").over(w.orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(w).alias("total"),
        F.sum("p").over(w).alias("positives"),
    )


def auc(df: DataFrame, score: str, *, by: Sequence[str] = ("target_id",), negatives: str = "labeled", digits: int = 6, empty: float | None = None, name: str = "auc") -> DataFrame:
    """Rank-sum AUC per target.

    ``negatives``: ``labeled`` compares positives with labelled negatives, ``all`` with every other
    row.  A target without both kinds gets ``empty``.
    """
    rows = df if negatives == "all" else df.filter(F.col("label_role").isin(POSITIVE, NEGATIVE))
    g = score_groups(rows, score, by=by)
    # a positive wins over all rows after its group and halves with the rest of its group
    q = F.max("total") - F.max("positives")
    running = F.sum("p").over(W.partitionBy(*by).orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, 0))
    later = F.col("positives") - running  # a frame that ends at the last row would be summed anew for each row
    g = g.withColumn("_win", F.col("p") * (F.col("total") - F.col("before") - F.col("n") - later + (F.col("n") - F.col("p")) / 2.0))
    value = F.when((F.max("positives") > 0) & (q > 0), rounded(F.sum("_win") / (F.max("positives") * q), digits)).otherwise(F.lit(empty).cast("double"))
    found = g.groupBy(*by).agg(value.alias(name))
    return df.select(*by).distinct().join(found, list(by), "left").withColumn(name, F.coalesce(F.col(name), F.lit(empty).cast("double")))


def early_retrieval(df: DataFrame, score: str, *, fraction: float = 0.01, by: Sequence[str] = ("target_id",)) -> DataFrame:
    """Recall and observed enrichment in the top fraction of the full pool."""
    ranked = stable_rank(df, score, by=by).withColumn("_n", F.count("*").over(W.partitionBy(*by)))
    k = top_count(F.col("_n"), fraction)
    agg = ranked.groupBy(*by).agg(
        F.max("_n").alias("n_pool"), F.max(k).alias("top_k"), F.count_if(is_positive()).alias("n_positive"), F.count_if(is_positive() & (F.col("rank") <= k)).alias("hits")
    )
    some = F.col("n_positive") > 0
    return agg.withColumn("recall", F.when(some, rounded(F.col("hits") / F.col("n_positive"), 6))).withColumn(
        "enrichment", F.when(some, rounded((F.col("hits") / F.col("top_k")) / (F.col("n_positive") / F.col("n_pool")), 6))
    )


def hits_within(df: DataFrame, score: str, sizes: Sequence[int], *, by: Sequence[str] = ("target_id",)) -> DataFrame:
    """(by, top, hits, recall): positives among the first rows, for fixed sizes."""
    ranked = stable_rank(df, score, by=by)
    wide = ranked.groupBy(*by).agg(F.count_if(is_positive()).alias("n_positive"), *[F.count_if(is_positive() & (F.col("rank") <= n)).alias(f"h{n}") for n in sizes])
    long = wide.select(*by, "n_positive", F.explode(F.array(*[F.struct(F.lit(n).alias("top"), F.col(f"h{n}").alias("hits")) for n in sizes])).alias("_x"))
    return long.select(*by, "n_positive", "_x.top", "_x.hits", F.when(F.col("n_positive") > 0, rounded(F.col("_x.hits") / F.col("n_positive"), 6)).alias("recall"))


def enrichment_tied(df: DataFrame, score: str, fractions: Sequence[float], *, by: Sequence[str] = ("target_id",)) -> DataFrame:
    """(by, fraction, enrichment): rows tied at the boundary share the slots that are left."""
    g = score_groups(df, score, by=by).withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
    k = F.greatest(F.lit(1), F.floor(F.col("total") * F.col("fraction"))).cast("long")
    share = F.when(F.col("before") + F.col("n") <= k, F.col("p").cast("double")).when(F.col("before") < k, (k - F.col("before")) * F.col("p") / F.col("n"))
    value = F.sum(share) / F.max(k) / (F.max("positives") / F.max("total"))
    return g.groupBy(*by, "fraction").agg(F.when(F.max("positives") > 0, rounded(value, 4)).otherwise(0.0).alias("enrichment"))


def bedroc_tied(df: DataFrame, score: str, *, alpha: float = 20.0, by: Sequence[str] = ("target_id",)) -> DataFrame:
    """(by, bedroc): early recognition; a group of ties counts with its mean over its ranks."""
    if alpha <= 0:
        raise ValueError("alpha must be above zero")
    g = score_groups(df, score, by=by)
    n, a = F.col("total").cast("double"), F.lit(float(alpha))
    q = F.exp(-a / n)
    part = F.col("p") / F.col("n") * F.pow(q, F.col("before") + 1) * (1.0 - F.pow(q, F.col("n"))) / (1.0 - q)
    s = g.groupBy(*by).agg(F.sum(part).alias("s"), F.max("total").alias("total"), F.max("positives").alias("positives"))
    ratio = F.col("positives") / n
    rie = F.col("s") / (F.col("positives") * (1.0 - F.exp(-a)) / (n * (F.exp(a / n) - 1.0)))
    most = (1.0 - F.exp(-a * ratio)) / (ratio * (1.0 - F.exp(-a)))
    least = (1.0 - F.exp(a * ratio)) / (ratio * (1.0 - F.exp(a)))
    value = F.when(F.col("positives") == 0, 0.0).when(most == least, 1.0).otherwise(rounded(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (rie - least) / (most - least))), 4))
    return s.select(*by, value.alias("bedroc"))


def bedroc_upper(df: DataFrame, score: str, *, alpha: float = 20.0, by: Sequence[str] = ("target_id",)) -> DataFrame:
    """(by, bedroc_upper): the older ratio to its maximum, at most 1, ties in row order.  It is near 1
    wherever positives are few, and is kept as a diagnostic only."""
    ranked = stable_rank(df, score, by=by).withColumn("_n", F.count("*").over(W.partitionBy(*by)))
    s = ranked.filter(is_positive()).groupBy(*by).agg(F.sum(F.exp(-F.lit(float(alpha)) * F.col("rank") / F.col("_n"))).alias("s"), F.count("*").alias("p"), F.max("_n").alias("n"))
    most = (1.0 - F.exp(-F.lit(float(alpha)) * F.col("p") / F.col("n"))) / (1.0 - F.exp(F.lit(-float(alpha))))
    return s.select(*by, rounded(F.least(F.lit(1.0), F.col("s") / most), 6).alias("bedroc_upper"))


def target_metrics(df: DataFrame, *, fraction: float = 0.01, scores: dict[str, str], statuses: Sequence[str] = (), gate: str | None = None) -> DataFrame:
    """One row per target: counts, and AUC, recall and enrichment for each of ``scores`` (column to
    suffix), failure rates and the gate's pass rate.

    All windows are partitioned by target (the AUC's by target and labelled or not), so rows are
    shuffled once, however many scores there are.
    """
    labeled = F.col("label_role").isin(POSITIVE, NEGATIVE)
    agg = [
        F.count("*").alias("n_pool"),
        F.count_if(is_positive()).alias("n_labeled_positive"),
        F.count_if(F.col("label_role") == NEGATIVE).alias("n_labeled_negative"),
        F.count_if(F.col("label_role") == BACKGROUND).alias("n_unlabeled_background"),
        *[rounded(1.0 - F.avg((F.col(s) == "ok").cast("double")), 8).alias(f"{s}_failure_rate") for s in statuses],
    ]
    if gate:
        agg.append(rounded(F.avg((F.col(gate) == "PASS").cast("double")), 8).alias("gate_pass_rate"))
    agg.append(top_count(F.count("*"), fraction).alias("top_k_1pct"))
    rows = df.repartition("target_id").withColumn("_n", F.count("*").over(W.partitionBy("target_id"))) if scores else df
    k = top_count(F.col("_n"), fraction)
    for i, column in enumerate(scores):
        value, lab, rank = finite(F.col(column)), f"_l{i}", f"_r{i}"
        rows = rows.withColumn(f"_v{i}", value).withColumn(lab, labeled & value.isNotNull())
        w = W.partitionBy("target_id", lab)
        mean_rank = F.rank().over(w.orderBy(f"_v{i}")) + (F.count("*").over(W.partitionBy("target_id", lab, f"_v{i}")) - 1) / 2.0
        rows = rows.withColumn(f"_a{i}", mean_rank)
        rows = rows.withColumn(rank, F.row_number().over(W.partitionBy("target_id").orderBy(F.col(f"_v{i}").desc_nulls_last(), "candidate_index")))
        p, q = F.count_if(F.col(lab) & is_positive()), F.count_if(F.col(lab) & ~is_positive())
        total = F.sum(F.when(F.col(lab) & is_positive(), F.col(f"_a{i}")))
        hits, some, suffix = F.count_if(is_positive() & (F.col(rank) <= k)), F.count_if(is_positive()), scores[column]
        agg += [
            F.when((p > 0) & (q > 0), rounded((total - p * (p + 1) / 2.0) / (p * q), 6)).alias(f"auc_{suffix}_labeled"),
            F.when(some > 0, rounded(hits / some, 6)).alias(f"recall_at_1pct_{suffix}"),
            F.when(some > 0, rounded((hits / F.max(k)) / (some / F.count("*")), 6)).alias(f"observed_enrichment_at_1pct_{suffix}"),
        ]
    return rows.groupBy("target_id").agg(*agg)


def overall_rank(df: DataFrame, score: str, *, name: str = "rank") -> DataFrame:
    """Rank over the whole table without one task sorting all rows or all scores.

    Rows are counted by distinct score, and scores by range (between quantiles of the scores); running
    counts are taken over ranges, and within each range over its scores.  Rows then get the rank of
    their score (the first of its ties); missing scores come last.
    """
    value = finite(F.col(score))
    per = df.groupBy(value.alias("_s")).agg(F.count("*").alias("_n"))
    edges = per.agg(F.percentile_approx("_s", [i / RANGES for i in range(1, RANGES)], 10_000).alias("_edges"))  # one row
    above = F.size(F.filter(F.coalesce("_edges", F.array().cast("array<double>")), lambda x: x > F.col("_s")))
    per = per.crossJoin(F.broadcast(edges)).withColumn("_range", F.when(F.col("_s").isNull(), F.lit(RANGES)).otherwise(above)).drop("_edges")
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = per.groupBy("_range").agg(F.sum("_n").alias("_n")).select("_range", before(W.partitionBy(F.lit(0)).orderBy("_range")).alias("_first"))
    within = before(W.partitionBy("_range").orderBy(F.col("_s").desc_nulls_last()))
    per = per.withColumn("_within", within).join(ranges, "_range").select("_s", (F.col("_first") + F.col("_within") + 1).alias(name))
    return df.join(per, value.eqNullSafe(F.col("_s"))).drop("_s")


def re_rank(df: DataFrame, key: str, *, by: Sequence[str] = ("target_id",), tie: Sequence[str] = ("candidate_index",), name: str = "dock_rank") -> DataFrame:
    """Ascending rank of rows that have ``key``; NULL for others."""
    w = W.partitionBy(*by).orderBy(F.col(key).asc_nulls_last(), *tie)
    return df.withColumn(name, F.when(F.col(key).isNotNull(), F.row_number().over(w)))


def page_start(df: DataFrame, score: str, position: str, offset: int) -> tuple[float, int] | None:
    """(score, position) of the row at place ``offset``, from 0, in descending order of score, then by position.

    Rows are counted by ranges of scores, and those of one score by ranges of positions, so nothing is sorted as
    a whole.  None beyond the last row.  Rows have a score and a position of their own.
    """
    falling = df.select((-F.col(score)).alias("_s"), F.col(position).cast("double").alias("_p"))

    def place(rows: DataFrame, value: str, at: int) -> tuple[float, int] | None:
        per, found = ranges.ranged(rows, value, [])
        here = found.filter((F.col("_first") <= at) & (F.col("_first") + F.col("_n") > at)).select("_range", "_first").first()
        if here is None:
            return None
        within = F.sum("_n").over(W.partitionBy("_range").orderBy("_v"))
        inside = per.filter(F.col("_range") == here["_range"]).withColumn("_to", F.lit(here["_first"]) + within).filter(F.col("_to") > at)
        row = inside.orderBy("_v").select("_v", (F.col("_to") - F.col("_n")).alias("_before")).first()
        return row["_v"], row["_before"]

    found = place(falling, "_s", offset)
    if found is None:
        return None
    tie = place(falling.filter(F.col("_s") == found[0]), "_p", offset - found[1])
    return -found[0], int(tie[0])


def page_from(df: DataFrame, score: str, position: str, start: tuple[float, int] | None, limit: int, *, after: bool = False) -> DataFrame:
    """The ``limit`` rows from ``start`` (score, position) on, or behind it: each task keeps that many."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be between 1 and 200")
    s, p = F.col(score), F.col(position)
    if start is not None:
        at = F.lit(start[0])
        df = df.filter((s < at) | (s == at) & ((p > start[1]) if after else (p >= start[1])))
    return df.filter(s.isNotNull()).orderBy(s.desc(), p).limit(limit)


def page(df: DataFrame, *, valid: Column, score: str, position: str, view: str, offset: int, limit: int) -> DataFrame:
    """A page of the ranked, failed or all rows, with the number of rows in the view."""
    if offset < 0 or not 1 <= limit <= 200:
        raise ValueError("offset must be at least 0 and limit between 1 and 200")
    rows = {"ranked": df.filter(valid), "failed": df.filter(~valid), "all": df}[view]
    order = [F.col(score).desc(), F.col(position)] if view == "ranked" else [F.col(position)]
    total = rows.agg(F.count("*").alias("total"))
    return rows.orderBy(*order).offset(offset).limit(limit).crossJoin(F.broadcast(total))
