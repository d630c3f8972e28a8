"""Labelled pairs: reconciliation, contamination, splits, pools and samples.

Where one engine shuffles with a random state, rows here are ordered by a hash of seed and keys: the
outcome doesn't depend on partitions, and SQL can repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import hash_order
from ..functions.session import saved


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_wins(df, keys, [F.col(o).desc() for o in order])


def ordered_distinct(df: DataFrame, key: str, position: str) -> DataFrame:
    """(key, position): distinct keys with the place where each came first."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(position).alias(position))


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Append of tables with the same columns, tagged with their source."""
    out = None
    for name, df in sources.items():
        tagged = df.withColumn("source", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def without_conflicts(pairs: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """Pairs whose key has one label only."""
    bad = pairs.groupBy(*keys).agg(F.min(label).alias("_lo"), F.max(label).alias("_hi")).filter("_lo <> _hi").select(*keys)
    return pairs.join(bad, list(keys), "left_anti")


def clean_pairs(pairs: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Valid labels, no conflicting keys, first row of each key; rows are shuffled and sorted once for both."""
    w = W.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = pairs.filter(F.col("label").isNotNull())
    rows = rows.select("*", F.row_number().over(w).alias("_rn"), F.min("label").over(whole).alias("_lo"), F.max("label").over(whole).alias("_hi"))
    return rows.filter("_rn = 1 and _lo = _hi").drop("_rn", "_lo", "_hi")


def stratified_split(pairs: DataFrame, keys: Sequence[str], *, held: float = 0.2, seed: int = 42, label: str = "label") -> DataFrame:
    """``pairs`` with ``split``: of each label, the first ``held`` part in hash order is held out.

    ``keys`` tell rows apart.  Rows of a label are counted by the first digits of the hash; only those whose digits
    hold the end of the held part are ranked, and the last one held tells the rest, so rows are not shuffled.
    """
    h = hash_order(seed, *[F.col(k) for k in keys])
    rows = saved(pairs, "pairs").withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 3))
    per = rows.groupBy(label, "_b").agg(F.count("*").alias("_n"))
    w = W.partitionBy(label)
    cut = F.rint(F.sum("_n").over(w) * F.lit(float(held))).alias("_cut")
    per = saved(per.select(label, "_b", "_n", F.coalesce(F.sum("_n").over(w.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), cut), "counts")
    at, after = F.struct("_h", *keys), F.col("_before") + F.col("_n")
    ends = rows.join(per.filter((F.col("_before") < F.col("_cut")) & (after > F.col("_cut"))), [label, "_b"])
    rank = F.row_number().over(W.partitionBy(label).orderBy("_h", *keys)) + F.col("_before")
    last = ends.withColumn("_rank", rank).filter("_rank = _cut").select(F.col(label), at.alias("_last"))
    per = saved(per.join(last, label, "left"), "places")
    is_held = F.when(after <= F.col("_cut"), True).when(F.col("_before") >= F.col("_cut"), False).otherwise(at <= F.col("_last"))
    out = rows.join(per, [label, "_b"]).withColumn("split", F.when(is_held, "heldout").otherwise("fit"))
    return out.drop("_h", "_b", "_n", "_before", "_cut", "_last")


def key_split(pairs: DataFrame, key: str, *, held: float = 0.2, seed: int = 42) -> DataFrame:
    """Split by a hash of the key alone: all rows of a key are on one side."""
    share = F.conv(F.substring(hash_order(seed, F.col(key)), 1, 7), 16, 10).cast("long") / F.lit(float(16**7))
    return pairs.withColumn("split", F.when(share < held, "heldout").otherwise("fit"))


def eligible(heldout: DataFrame, fit: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Held-out pairs that have an id, aren't in the fit pairs, don't conflict and are distinct."""
    clean = heldout.filter(F.col(keys[0]).isNotNull()).join(fit.select(*keys).distinct(), list(keys), "left_anti")
    return first_wins(without_conflicts(clean, keys), keys, order)


def target_counts(pairs: DataFrame, *, target: str = "target_id", key: str = "key", least: int = 5) -> DataFrame:
    """(target, positives, negatives, tier): strict with ``least`` of both labels."""
    agg = pairs.groupBy(target).agg(F.countDistinct(F.when(F.col("label") == 1, F.col(key))).alias("n_positive"), F.countDistinct(F.when(F.col("label") == 0, F.col(key))).alias("n_negative"))
    tier = F.when((F.col("n_positive") >= least) & (F.col("n_negative") >= least), "strict_labeled").otherwise("limited_positive")
    return agg.filter("n_positive > 0").withColumn("tier", tier)


def select_targets(counts: DataFrame, fallback: DataFrame, n: int, *, target: str = "target_id", texts: DataFrame | None = None) -> DataFrame:
    """Exactly ``n`` targets with their place: by tier, positives, negatives and id, then fallback ids.

    ``fallback`` has (target, position) and is taken in the order of its positions; fewer than ``n``
    targets are an error.  ``text`` is what ``texts`` (target, text) has for the target, else its id.
    """
    order = {"strict_labeled": 0, "limited_positive": 1}
    tier = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])[F.col("tier")]
    rows = counts.select(target, "tier", "n_positive", "n_negative", tier.alias("_t"), F.lit(0).cast("long").alias("_p"))
    zero = F.lit(0).cast("long")
    more = ordered_distinct(fallback.select(target, F.col("position").cast("long").alias("_p")), target, "_p").join(counts, target, "left_anti")
    more = more.select(target, F.lit("unlabeled_fallback").alias("tier"), zero.alias("n_positive"), zero.alias("n_negative"), F.lit(2).alias("_t"), "_p")
    keys = ["_t", F.col("n_positive").desc(), F.col("n_negative").desc(), "_p", target]
    best = saved(rows.unionByName(more).orderBy(*keys).limit(n), "targets")
    out = best.withColumn("target_index", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*keys)) - 1).drop("_t", "_p")  # n rows
    found = best.count()
    if found < n:
        raise ValueError(f"{found} targets, expected {n}")
    if texts is not None:
        out = out.join(texts.select(target, "text"), target, "left")
    return out.withColumn("text", F.coalesce("text", F.col(target).cast("string")) if texts is not None else F.col(target).cast("string"))


def fill_targets(counts: DataFrame, sequences: DataFrame, every: DataFrame, n: int, *, least: int = 5, target: str = "target_id", seed: int = 42) -> DataFrame:
    """(target, labelled, place): targets with ``least`` positives and a sequence come first, by id; the
    rest is filled up to ``n`` in hash order."""
    good = counts.filter(F.col("n_positive") >= least).join(sequences.select(target).distinct(), target, "left_semi").select(target, F.lit(True).alias("labelled"), F.lit("").alias("_h"))
    rest = every.select(target).distinct().join(good, target, "left_anti").select(target, F.lit(False).alias("labelled"), hash_order(seed, F.col(target)).alias("_h"))
    keys = [F.col("labelled").desc(), "_h", target]
    best = good.unionByName(rest).orderBy(*keys).limit(n)
    return best.withColumn("place", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*keys)) - 1).drop("_h")  # n rows


def sample(df: DataFrame, n: int, keys: Sequence[str], seed: int | str = 42) -> DataFrame:
    """``n`` rows in hash order: the same ones on any number of partitions."""
    return df.orderBy(hash_order(seed, *[F.col(k) for k in keys]), *keys).limit(n)


def sample_per(df: DataFrame, n: Column | int, by: Sequence[str], keys: Sequence[str], seed: int | str = 42) -> DataFrame:
    """Up to ``n`` rows of each group in hash order, with their place."""
    w = W.partitionBy(*by).orderBy(hash_order(seed, *[F.col(k) for k in [*by, *keys]]), *keys)
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def candidate_pools(labels: DataFrame, library: DataFrame, excluded: DataFrame, size: int, *, target: str = "target_id", key: str = "key", seed: int = 42) -> DataFrame:
    """(target, key, label, label_role, candidate_index): pools of exactly ``size`` rows per target.

    A pool has the target's labelled keys and, from the library, unlabelled keys that aren't excluded
    for that target, in hash order.  Only the first ``size`` plus excluded keys of a target's order can
    be needed, so the library isn't paired with targets as a whole: each target walks a stretch of a
    ring of the library's keys in hash order, which starts at the target's own hash.  Steps at which it would come to
    excluded keys are told from those keys' places, so only the rows of the pools are made.
    """
    ring = 16**6
    place = lambda *c: F.conv(F.substring(hash_order(seed, *c), 1, 6), 16, 10).cast("long")
    lib = library.select(key).distinct()
    n_lib = lib.count()
    labelled = labels.select(target, key, "label")
    taken = labelled.select(target, key).union(excluded.select(target, key)).distinct()
    need = labelled.groupBy(target).agg(F.count("*").alias("_have"))
    blocked = taken.groupBy(target).agg(F.count("*").alias("_taken"))
    start = F.pmod(place(F.col(target)), F.lit(max(1, n_lib)))
    need = need.join(blocked, target).filter(F.col("_have") < size).withColumn("_want", F.least(F.lit(n_lib), F.lit(size) - F.col("_have") + F.col("_taken")))
    need = saved(need.filter("_want > 0").select(target, (F.lit(size) - F.col("_have")).cast("int").alias("_free"), F.col("_want").cast("int").alias("_want"), start.alias("_start")), "targets")
    # Keys get their order on the ring; the order is counted by slices of the ring, then within a slice.
    slices = max(1, min(4096, n_lib // 256))
    at = lib.withColumn("_at", place(F.col(key))).withColumn("_slice", F.floor(F.col("_at") * slices / ring))
    per = at.groupBy("_slice").agg(F.count("*").alias("_n"))
    per = per.withColumn("_first", F.coalesce(F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    at = at.join(per, "_slice").withColumn("_no", F.col("_first") + F.row_number().over(W.partitionBy("_slice").orderBy("_at", key)) - 1)
    at = saved(at.select("_no", key), "ring")
    shut = taken.join(at, key).join(need, target).select(target, "_want", F.pmod(F.col("_no") - F.col("_start"), F.lit(max(1, n_lib))).cast("int").alias("_step"))
    shut = shut.filter("_step < _want").groupBy(target).agg(F.collect_list("_step").alias("_shut"))  # fewer than are wanted
    steps = F.array_except(F.sequence(F.lit(0), F.col("_want") - 1), F.coalesce("_shut", F.array().cast("array<int>")))
    tasks = int(library.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a target is a short row, and many rows then
    walk = need.join(shut, target, "left").repartition(tasks, target).select(target, "_start", F.explode(F.slice(steps, F.lit(1), F.col("_free"))).alias("_step"))
    walk = walk.withColumn("_no", F.pmod(F.col("_start") + F.col("_step"), F.lit(max(1, n_lib))))
    background = walk.join(at, "_no").select(target, key, F.lit(None).cast("int").alias("label"))
    role = F.when(F.col("label") == 1, "heldout_positive").when(F.col("label") == 0, "heldout_negative").otherwise("unlabeled_background")
    pool = labelled.select(target, key, F.col("label").cast("int").alias("label")).unionByName(background).withColumn("label_role", role)
    order = W.partitionBy(target).orderBy(hash_order(f"{seed}-pool", F.col(target), F.col(key)), key)
    return pool.withColumn("candidate_index", F.row_number().over(order) - 1)


def label_map(pairs: DataFrame, *, target: str = "target_id", key: str = "key") -> DataFrame:
    """(target, pos, neg): sorted distinct keys by label."""
    side = lambda v: F.sort_array(F.collect_set(F.when(F.col("label") == v, F.col(key))))
    return pairs.groupBy(target).agg(side(1).alias("pos"), side(0).alias("neg"))


def most_frequent(df: DataFrame, by: Sequence[str], value: str, position: str) -> DataFrame:
    """Value with the highest count per key; of equals the one that came first."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"), F.min(position).alias("_first"))
    w = W.partitionBy(*by).orderBy(F.col("n").desc(), "_first")
    return counts.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_first")
