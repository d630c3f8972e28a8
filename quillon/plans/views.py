"""Adapter views: the given tables as candidate scores, labelled pairs, descriptors and so on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import FOUR_LAYER, combine
from ..functions.session import enough_partitions
from ..operators.ranking import BACKGROUND, NEGATIVE, POSITIVE


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return enough_partitions(spark.read.parquet(f"{sf}/{name}.parquet"))


ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def pair_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate scores: a supplier is a target, a line item a candidate, the return flag its role."""
    li = table(spark, sf, "lineitem")
    role = F.when(F.col("l_returnflag") == "R", POSITIVE).when(F.col("l_returnflag") == "A", NEGATIVE).otherwise(BACKGROUND)
    rows = li.select(
        F.col("l_suppkey").alias("target_id"),
        (F.row_number().over(W.partitionBy("l_suppkey").orderBy(*ORDER)) - 1).cast("long").alias("candidate_index"),
        F.col("l_partkey").alias("part_key"),
        (F.col("l_tax") / 0.08).alias("l1"),
        (F.col("l_discount") / 0.10).alias("l2"),
        (F.col("l_quantity") / 50).alias("l3"),
        (F.col("l_extendedprice") / 105000).alias("l4"),
        F.col("l_extendedprice").alias("price"),
        role.alias("label_role"),
    )
    return rows.withColumn("final_score", combine(FOUR_LAYER))


#: The same view for DuckDB.
PS = """
ps0 AS (
  SELECT l_suppkey AS target_id,
         CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS BIGINT) AS candidate_index,
         l_partkey AS part_key, l_tax / 0.08::DOUBLE AS l1, l_discount / 0.10::DOUBLE AS l2, l_quantity / 50 AS l3, l_extendedprice / 105000 AS l4,
         l_extendedprice AS price,
         CASE l_returnflag WHEN 'R' THEN 'heldout_positive' WHEN 'A' THEN 'heldout_negative' ELSE 'unlabeled_background' END AS label_role
  FROM lineitem),
ps AS (
  SELECT *, round_even((0.20::DOUBLE * l1 + 0.50::DOUBLE * l2 + 0.20::DOUBLE * l3 + 0.10::DOUBLE * l4) * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE AS final_score
  FROM ps0)"""


def descriptors(spark: SparkSession, sf: str) -> DataFrame:
    """A part as a molecule: size and price give properties, its key gives counts."""
    k, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("part_key"),
        (price / 2).alias("mw"),
        ((k % 101) / 10.0 - 3).alias("logp"),
        ((k % 223) * 1.0).alias("tpsa"),
        (k % 9).alias("hbd"),
        (k % 17).alias("hba"),
        (k % 13).alias("rotatable"),
        size.cast("long").alias("heavy"),
        (k % 6).alias("rings"),
        (k % 5).alias("aromatic"),
        (k % 3).alias("aliphatic"),
        (k % 11).alias("hetero"),
        (k % 4).alias("halogen"),
        ((k % 97) / 97.0).alias("qed"),
        (k % 3 - k % 2).alias("_s"),
        F.greatest(F.lit(0), k % 7 - 4).alias("severe"),
        F.greatest(F.lit(0), k % 5 - 2).alias("moderate"),
        F.when(k % 10 != 0, (k % 19) / 19.0).alias("tox21"),
        F.when(k % 12 != 0, (k % 23) / 23.0).alias("clintox"),
        F.when(k % 14 != 0, (k % 29) / 29.0).alias("sider"),
        ((k % 31) / 31.0).alias("bbb"),
        (k % 50 == 0).alias("heavy_metal"),
        (k % 40 == 1).alias("cyanide"),
        (k % 80 == 1).alias("alkali"),
    ).drop("_s")


DE = """
de AS (
  SELECT p_partkey AS part_key, p_retailprice / 2 AS mw, (p_partkey % 101) / 10.0::DOUBLE - 3 AS logp, (p_partkey % 223) * 1.0::DOUBLE AS tpsa,
         p_partkey % 9 AS hbd, p_partkey % 17 AS hba, p_partkey % 13 AS rotatable, CAST(p_size AS BIGINT) AS heavy, p_partkey % 6 AS rings,
         p_partkey % 5 AS aromatic, p_partkey % 3 AS aliphatic, p_partkey % 11 AS hetero, p_partkey % 4 AS halogen, (p_partkey % 97) / 97.0::DOUBLE AS qed,
         greatest(0, p_partkey % 7 - 4) AS severe, greatest(0, p_partkey % 5 - 2) AS moderate,
         CASE WHEN p_partkey % 10 <> 0 THEN (p_partkey % 19) / 19.0::DOUBLE END AS tox21,
         CASE WHEN p_partkey % 12 <> 0 THEN (p_partkey % 23) / 23.0::DOUBLE END AS clintox,
         CASE WHEN p_partkey % 14 <> 0 THEN (p_partkey % 29) / 29.0::DOUBLE END AS sider,
         (p_partkey % 31) / 31.0::DOUBLE AS bbb, p_partkey % 50 = 0 AS heavy_metal, p_partkey % 40 = 1 AS cyanide, p_partkey % 80 = 1 AS alkali
  FROM part)"""


def r(x: str, digits: int) -> str:
    """DuckDB text for rounding half to even."""
    p = f"{10**digits}.0::DOUBLE"
    return f"(round_even(({x}) * {p}, 0) / {p})"
