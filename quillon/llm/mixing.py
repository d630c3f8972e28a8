"""Mixing sources to target weights by hash-threshold histograms.

Every source gets a word budget.  Documents are ordered by a hash of their id, and a source
takes the documents below a hash threshold, so taking is a filter and needs no sort: words are
summed by source and hash bucket, the bucket in which the budget ends is found, and only that
bucket is refined (twice by 4,096, then by the single hashes that are left in one cell).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import save

#: Hex digits of the hash per level of the histogram: 4,096 buckets, then 4,096 in one of them.
DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty.  Only the six ASCII blanks part words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def order_hash(key: Column) -> Column:
    """Hex digest that orders documents; a null key hashes as the empty text."""
    return F.md5(F.coalesce(key.cast("string"), F.lit("")))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeats: float) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Sources weigh ``weights``, repeating, by code point order with null last.  They share ``share``
    times all words; no target exceeds ``max_repeats`` times its source, and what is above goes to
    the others by weight.  That fixed point is ``min(cap, level * weight)`` for one level, found
    from running sums over the sources by ``cap / weight``.  The windows see one row per source.
    """
    w = F.array(*[F.lit(float(x)) for x in weights])
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    everything = W.partitionBy(F.lit(0))
    per = per.withColumn("n", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())))
    per = per.select(
        "source",
        "source_size",
        "n",
        F.element_at(w, ((F.col("n") - 1) % len(weights)) + 1).alias("weight"),
        (F.col("source_size") * F.lit(float(max_repeats))).alias("cap"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("budget"),
    )
    before = everything.orderBy(F.col("cap") / F.col("weight"), "n").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn(
        "level",
        (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    # The first source, in that order, whose cap is not reached sets the level for all after it.
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "n", "level"))).over(everything)
    return per.select(
        "source",
        "source_size",
        F.when(level.isNull(), F.col("cap")).otherwise(F.least("cap", level["level"] * F.col("weight"))).alias("target"),
    )


def _boundary(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Of each source, the cell in which its budget ends, with the words before it."""
    w = W.partitionBy(*keys).orderBy("cell").rowsBetween(W.unboundedPreceding, 0)
    cells = cells.withColumn("upto", F.sum("words").over(w) + F.col("start"))
    return cells.filter((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left")))


def thresholds(sizes: DataFrame, targets: DataFrame, max_repeats: float) -> DataFrame:
    """(source, source_size, target, rounds, cut): all of a source is taken ``rounds`` times and
    documents with a hash up to ``cut`` once more.

    A document is in the last round if the middle of its words, in hash order, is within the
    budget; so a source is off its target by half a document at most.  Rows with one hash (repeated
    ids) are in or out together.
    """
    targets = targets.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    left = targets.select("source", (F.col("target") - F.col("rounds") * F.col("source_size")).alias("left"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])

    level = sizes.groupBy("source", F.substring("hash", 1, DIGITS).alias("cell")).agg(F.sum("size").alias("words"))
    level = level.join(left.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).withColumn("start", F.lit(0))
    one = _boundary(level, ["source"]).select(F.col("source").alias("s"), F.col("cell").alias("c1"), "left", (F.col("upto") - F.col("words")).alias("start"))

    inside = sizes.join(one, F.col("source").eqNullSafe(F.col("s")) & (F.substring("hash", 1, DIGITS) == F.col("c1")))
    level = inside.groupBy("source", "c1", "left", "start", F.substring("hash", 1, 2 * DIGITS).alias("cell")).agg(F.sum("size").alias("words"))
    two = _boundary(level, ["source"]).select(F.col("source").alias("s"), F.col("cell").alias("c2"), "left", (F.col("upto") - F.col("words")).alias("start"))

    inside = sizes.join(two, F.col("source").eqNullSafe(F.col("s")) & (F.substring("hash", 1, 2 * DIGITS) == F.col("c2")))
    level = inside.groupBy("source", "c2", "left", "start", F.col("hash").alias("cell")).agg(F.sum("size").alias("words"))
    w = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, 0)
    level = level.withColumn("middle", F.col("start") + F.sum("words").over(w) - F.col("words") / 2)
    cut = level.groupBy(F.col("source").alias("s")).agg(
        F.coalesce(F.max(F.when(F.col("middle") <= F.col("left"), F.col("cell"))), F.min("c2")).alias("cut")
    )
    # 'g' is above all hex digits: no cell holds the budget's end, so all of the source is within it.
    return targets.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "rounds", F.coalesce("cut", F.lit("g")).alias("cut")
    )


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_repeats: float = 2,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decide how often the mix takes each document.

    Returns per row of ``docs``: the id, ``keep`` columns, ``size`` (words), ``source_size``,
    ``target``, ``repeats`` and ``taken`` (words taken, repeats counted).  Null and empty texts have
    size 0 and are taken 0 words; a null source is a source of its own; an empty table gives no rows.
    Rows with equal ids are taken alike.  The result depends on ids and texts only, so reruns agree.
    Text isn't shuffled: only (source, hash, size) rows are, summed before the shuffle.
    """
    base = docs.select(F.col(source_col).alias("source"), order_hash(F.col(id_col)).alias("hash"), word_count(F.col(text_col)).alias("size"), F.col(id_col).alias("id"))
    sizes = save(base, "mix-sizes")
    cuts = save(thresholds(sizes, source_targets(sizes, weights, share, max_repeats), max_repeats), "mix-cuts")
    cuts = cuts.withColumnRenamed("source", "_cut_source")
    if keep:
        rows = docs.select(
            *[F.col(c) for c in dict.fromkeys([id_col, *keep])], F.col(source_col).alias("_source"), order_hash(F.col(id_col)).alias("_hash"), word_count(F.col(text_col)).alias("size")
        )
    else:
        rows = sizes.select(F.col("id").alias(id_col), F.col("source").alias("_source"), F.col("hash").alias("_hash"), "size")
    rows = rows.join(cuts, F.col("_source").eqNullSafe(F.col("_cut_source")), "left")
    # a budget that is used up in whole rounds has no last round
    more = (F.col("_hash") <= F.col("cut")) & (F.col("target") > F.col("rounds") * F.col("source_size"))
    repeats = F.col("rounds") + F.when(more, 1).otherwise(0)
    return rows.withColumn("repeats", repeats.cast("long")).withColumn("taken", (F.col("size") * F.col("repeats")).cast("long")).drop("_source", "_hash", "_cut_source", "rounds", "cut")


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents, mixed by weights 5, 2, 1 to 150% of their words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


#: The same mix with a sort by hash instead of histograms.
OP4_SQL = r"""
WITH s AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS hash,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
p AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS n
  FROM s GROUP BY source),
c AS (
  SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget
  FROM p),
l AS (
  SELECT *, (budget - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM c WINDOW w AS (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level AS fill FROM l WHERE level * weight <= cap ORDER BY cap / weight, n LIMIT 1),
t AS (
  SELECT source, source_size, least(cap, coalesce((SELECT fill FROM f) * weight, cap)) AS target
  FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS rounds FROM t),
h AS (
  SELECT source, hash, sum(size) AS words,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) - sum(size) / 2.0 AS middle
  FROM s GROUP BY source, hash)
SELECT s.doc_id, s.size, r.source_size, r.target,
       CAST(s.size * (r.rounds + CASE WHEN h.middle <= r.target - r.rounds * r.source_size AND r.target > r.rounds * r.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM s JOIN r ON s.source IS NOT DISTINCT FROM r.source
JOIN h ON s.source IS NOT DISTINCT FROM h.source AND s.hash = h.hash
"""
