"""Evidence of single layers: alert roll-up, model risks, nested details, strict status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.layers import alert_penalty


def keyword_hits(docs: DataFrame, alerts: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key, alert, n) for alerts (alert, pattern, severity) whose word is in a text.

    Texts are split into words once and joined on them, so the work follows the words and not the
    number of alerts times the texts.  Alerts may be any number; the planner broadcasts a small table.
    """
    words = docs.select(key, F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+")).alias("pattern")).filter("pattern <> ''")
    return words.join(alerts, "pattern").groupBy(key, "alert").agg(F.count("*").alias("n"))


def roll_up(rows: DataFrame, hits: DataFrame, alerts: DataFrame, *, key: str) -> DataFrame:
    """Per row: severe and moderate alerts, their names in order, the penalty and the flag text."""
    named = hits.join(alerts.select("alert", "severity"), "alert")
    severe = F.col("severity") == "severe"
    agg = named.groupBy(key).agg(
        F.count_if(severe).alias("severe"), F.count_if(~severe).alias("moderate"),
        F.array_join(F.sort_array(F.collect_list(F.when(severe, F.col("alert")))), ";").alias("_s"),
        F.array_join(F.sort_array(F.collect_list(F.when(~severe, F.col("alert")))), ";").alias("_m"),
    )
    out = rows.select(key).join(agg, key, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("severe", "moderate")})
    part = lambda name, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"{name}: "), F.col(c)))
    text = F.concat_ws(" | ", part("SEVERE", "_s"), part("MODERATE", "_m"))
    return out.select(key, "severe", "moderate", alert_penalty(F.col("severe"), F.col("moderate")).alias("penalty"), F.when(text == "", "low").otherwise(text).alias("flags"))


def mean_risk(tasks: Column, *, empty: float, above: float | None = None, unit: int = 10**8) -> Column:
    """Mean of a task-to-risk map (of the risks over ``above`` only); ``empty`` if there is none.

    Risks are whole numbers of parts in ``unit``, so that their sum depends on no order.
    """
    v = F.map_values(tasks)
    if above is not None:
        v = F.filter(v, lambda x: x > round(above * unit))
    mean = F.aggregate(v, F.lit(0).cast("long"), lambda s, x: s + x) / F.size(v) / F.lit(float(unit))
    return F.when(F.size(v) > 0, mean).otherwise(F.lit(empty))


def flatten_details(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Named fields of a JSON text as columns of the given types; NULL where a field is missing."""
    schema = ", ".join(f"`{n}` {t}" for n, t in fields.items())
    return df.withColumn("_d", F.from_json(column, schema)).select(*[c for c in df.columns if c != column], *[F.col(f"_d.{n}").alias(n) for n in fields])


def strict(df: DataFrame, statuses: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every status ok, counts of the others by status column)."""
    ok = None
    for s in statuses:
        ok = (F.col(s) == "ok") if ok is None else ok & (F.col(s) == "ok")
    bad = df.select(F.explode(F.array(*[F.struct(F.lit(s).alias("layer"), F.col(s).alias("status")) for s in statuses])).alias("_x")).select("_x.*").filter("status <> 'ok'")
    return df.filter(F.coalesce(ok, F.lit(False))), bad.groupBy("layer", "status").agg(F.count("*").alias("n"))


def described(targets: DataFrame, metadata: DataFrame, *, key: str, parts: Sequence[str]) -> DataFrame:
    """Targets with a text made of what the metadata knows about them; the key alone otherwise."""
    m = metadata.select(key, F.concat_ws(" ", *parts).alias("_t"))
    return targets.join(m, key, "left").withColumn("text", F.coalesce(F.nullif("_t", F.lit("")), F.col(key).cast("string"))).drop("_t")


def activity(library: DataFrame, actives: DataFrame, *, key: str) -> DataFrame:
    """Library rows with y = 1 for known actives and 0 for all others."""
    y = actives.select(key).distinct().withColumn("_y", F.lit(1))
    return library.join(y, key, "left").withColumn("y", F.coalesce("_y", F.lit(0))).drop("_y")
