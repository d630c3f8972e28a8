"""Audits: every rule is a count of rows that break it, and whole tables are compared by joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import finite
from .ranking import BACKGROUND, NEGATIVE, POSITIVE


def rules(df: DataFrame, checks: Mapping[str, Column], by: Sequence[str] = ("target_id",)) -> DataFrame:
    """(by, rule, violations): rows of each group for which a check is not true, in one pass."""
    wide = df.groupBy(*by).agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    long = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in checks])
    return wide.select(*by, F.explode(long).alias("_x")).select(*by, "_x.rule", "_x.violations")


def score_checks(layers: Sequence[str], score: str, expected: Column, statuses: Sequence[str] = (), tolerance: float = 1e-4) -> dict[str, Column]:
    out = {"role": F.col("label_role").isin(POSITIVE, NEGATIVE, BACKGROUND)}
    for c in (*layers, score):
        out[f"finite_{c}"] = finite(F.col(c)).isNotNull()
        out[f"range_{c}"] = finite(F.col(c)).isNull() | F.col(c).between(0, 1)
    out["formula"] = F.abs(F.col(score) - expected) <= tolerance
    for s in statuses:
        out[f"ok_{s}"] = F.col(s) == "ok"
    return out


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def cardinality(df: DataFrame, manifest: DataFrame, key: str, size: str) -> DataFrame:
    """Groups whose number of rows differs from the manifest, on either side."""
    n = df.groupBy(key).agg(F.count("*").alias("n_rows"))
    both = n.join(manifest.select(key, size), key, "full_outer")
    return both.filter(~F.col("n_rows").eqNullSafe(F.col(size))).select(key, "n_rows", size)


def contamination(rows: DataFrame, fit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in common with the fit pairs, by role; should have none."""
    return rows.join(fit.select(*keys), list(keys), "left_semi").groupBy("label_role").agg(F.count("*").alias("n"))


def identity(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """(key, problem): missing, unexpected, or changed rows."""
    e = expected.select(F.col(key), F.col(value).alias("_e"), F.lit(True).alias("_in_e"))
    a = actual.select(F.col(key), F.col(value).alias("_a"), F.lit(True).alias("_in_a"))
    both = e.join(a, key, "full_outer")
    problem = F.when(F.col("_in_a").isNull(), "missing").when(F.col("_in_e").isNull(), "unexpected").when(~F.col("_e").eqNullSafe(F.col("_a")), "changed")
    return both.select(key, problem.alias("problem")).filter("problem is not null")


def changed_columns(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(column, changed): rows whose value differs after a step that should only add columns."""
    a = before.select(*keys, F.struct(*columns).alias("_a"))
    b = after.select(*keys, F.struct(*columns).alias("_b"))
    wide = a.join(b, list(keys)).agg(*[F.count_if(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}"))).alias(c) for c in columns])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("changed")) for c in columns])).alias("_x")).select("_x.*")


def parity(a: DataFrame, b: DataFrame, keys: Sequence[str], numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """(field, n, mismatches, largest): two runs of one input, field by field."""
    x = a.select(*keys, F.struct(*numeric, *categorical).alias("_a"))
    y = b.select(*keys, F.struct(*numeric, *categorical).alias("_b"))
    both = x.join(y, list(keys))
    agg = []
    for c in numeric:
        va, vb = finite(F.col(f"_a.{c}")), finite(F.col(f"_b.{c}"))
        agg.append(F.struct(F.lit(c).alias("field"), F.count("*").alias("n"), F.count_if(va.isNull() != vb.isNull()).alias("mismatches"), F.max(F.abs(va - vb)).alias("largest")))
    for c in categorical:
        agg.append(F.struct(F.lit(c).alias("field"), F.count("*").alias("n"), F.count_if(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}"))).alias("mismatches"), F.lit(None).cast("double").alias("largest")))
    return both.agg(F.array(*agg).alias("_x")).select(F.explode("_x").alias("_x")).select("_x.*")


def total_join(rows: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """``rows`` with the cache's columns; a key that the cache lacks is an error that names some."""
    missing = rows.select(key).distinct().join(cache.select(key), key, "left_anti")
    some = [r[0] for r in missing.limit(5).collect()]
    if some:
        raise ValueError(f"the cache lacks keys such as {', '.join(map(str, some))}")
    return rows.join(cache, key)


def selection(expected: DataFrame, actual: DataFrame, keys: Sequence[str], rank: str, by: str = "target_id") -> DataFrame:
    """(by, n_expected, wrong_rank, missing, unexpected): a stored selection against a new one."""
    e = expected.select(by, *keys, F.col(rank).alias("_e"))
    a = actual.select(by, *keys, F.col(rank).alias("_a"))
    both = e.join(a, [by, *keys], "full_outer")
    return both.groupBy(by).agg(F.count("_e").alias("n_expected"), F.count_if(F.col("_e") != F.col("_a")).alias("wrong_rank"), F.count_if(F.col("_a").isNull()).alias("missing"), F.count_if(F.col("_e").isNull()).alias("unexpected"))


def compare_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, problem) of a manifest (path, digest) against the files there are."""
    both = manifest.select("path", F.col("digest").alias("_m"), F.lit(True).alias("_in_m")).join(files.select("path", F.col("digest").alias("_f"), F.lit(True).alias("_in_f")), "path", "full_outer")
    problem = (
        F.when(F.col("_in_f").isNull(), "missing").when(F.col("_in_m").isNull(), "unexpected").when(~F.coalesce(F.col("_m").rlike("^[0-9a-f]{64}$"), F.lit(False)), "malformed").when(F.col("_m") != F.col("_f"), "mismatch")
    )
    return both.select("path", problem.alias("problem")).filter("problem is not null")


def digest(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, rows, digest): fingerprint of a set of rows in any order.

    Digests of rows are summed in four 60-bit parts, so no task holds a group and partial sums are
    merged; the sums' text is hashed once more.
    """
    h = df.select(*by, F.sha2(F.to_json(F.struct(*sorted(columns))), 256).alias("_h"))
    parts = [F.sum(F.conv(F.substring("_h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).alias(f"_{i}") for i in range(4)]
    return h.groupBy(*by).agg(F.count("*").alias("rows"), *parts).select(*by, "rows", F.sha2(F.concat_ws("|", *[F.col(f"_{i}").cast("string") for i in range(4)]), 256).alias("digest"))


def canonical(df: DataFrame) -> DataFrame:
    """One JSON text per row with its fields sorted by name, and the text's digest."""
    text = F.to_json(F.struct(*sorted(df.columns)))
    return df.select(text.alias("json")).withColumn("digest", F.sha2("json", 256))
