"""Alerts, model risks, nested details, strict status and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import rounded
from ..operators import evidence
from .q_labels import PAIRS, clean
from .views import r, table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


#: Words that count as alerts, with their severity.
ALERTS = [("insult_a", "idiot", "severe"), ("insult_b", "scum", "severe"), ("waste", "trash", "moderate"), ("disgust", "disgusting", "moderate"), ("worth", "worthless", "moderate")]
VALUES = ", ".join(f"('{a}', '{p}', '{s}')" for a, p, s in ALERTS)


@query(
    "alert_rollup",
    f"""WITH al AS (SELECT * FROM (VALUES {VALUES}) v(alert, pattern, severity)), w AS (SELECT doc_id, unnest(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}]+')) AS pattern FROM documents),
h AS (SELECT DISTINCT doc_id, alert, severity FROM w JOIN al USING (pattern)),
a AS (SELECT doc_id, count(*) FILTER (severity = 'severe') AS severe, count(*) FILTER (severity = 'moderate') AS moderate, string_agg(alert, ';' ORDER BY alert) FILTER (severity = 'severe') AS s, string_agg(alert, ';' ORDER BY alert) FILTER (severity = 'moderate') AS m FROM h GROUP BY 1)
SELECT d.doc_id, coalesce(severe, 0) AS severe, coalesce(moderate, 0) AS moderate, greatest(0.0::DOUBLE, least(0.85::DOUBLE, coalesce(severe, 0) * 0.30::DOUBLE + coalesce(moderate, 0) * 0.22::DOUBLE)) AS penalty,
       coalesce(nullif(concat_ws(' | ', 'SEVERE: ' || s, 'MODERATE: ' || m), ''), 'low') AS flags FROM documents d LEFT JOIN a USING (doc_id)""",
)
def alert_rollup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    alerts = spark.createDataFrame(ALERTS, "alert string, pattern string, severity string")
    return evidence.roll_up(docs, evidence.keyword_hits(docs, alerts, key="doc_id", text="text"), alerts, key="doc_id")


@query(
    "model_risk",
    f"""WITH x AS (SELECT user_id, event_type, CAST(round_even(sum(CAST(round_even(value * 10000, 0) AS BIGINT)) / count(*) * 100.0::DOUBLE, 0) AS BIGINT) AS risk FROM events GROUP BY ALL)
SELECT user_id, count(*) AS n_tasks, {r('sum(risk) / count(*) / 100000000.0::DOUBLE', 6)} AS mean_risk,
       coalesce({r('sum(risk) FILTER (risk > 80000000) / count(*) FILTER (risk > 80000000) / 100000000.0::DOUBLE', 6)}, 0) AS high_risk FROM x GROUP BY user_id""",
)
def model_risk(spark, sf):
    """Task-to-risk maps (in parts of 10**8) and their means; the second one over high risks only."""
    units = F.rint(F.sum(F.rint(F.col("value") * 10000).cast("long")) / F.count("*") * 100.0).cast("long")
    per = table(spark, sf, "events").groupBy("user_id", "event_type").agg(units.alias("risk"))
    maps = per.groupBy("user_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("event_type", "risk")))).alias("tasks"))
    high = evidence.mean_risk(F.col("tasks"), empty=0.0, above=0.8)
    return maps.select("user_id", F.size("tasks").cast("long").alias("n_tasks"), rounded(evidence.mean_risk(F.col("tasks"), empty=0.5), 6).alias("mean_risk"), rounded(high, 6).alias("high_risk"))


@query("detail_flatten", "SELECT p_partkey, p_size AS size, p_brand AS brand, CAST(NULL AS DOUBLE) AS missing FROM part")
def detail_flatten(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.to_json(F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand"), F.lit(1).alias("other"))).alias("details"))
    return evidence.flatten_details(rows, "details", {"size": "int", "brand": "string", "missing": "double"})


STATUS = "CASE WHEN l_orderkey % 37 = 0 THEN 'failed:timeout' ELSE 'ok' END AS l1_status, CASE WHEN l_partkey % 41 = 0 THEN 'error:value' ELSE 'ok' END AS l3_status"


@query("strict_status", f"WITH x AS (SELECT {STATUS} FROM lineitem) SELECT 'l1_status' AS layer, l1_status AS status, count(*) AS n FROM x WHERE l1_status <> 'ok' GROUP BY ALL UNION ALL SELECT 'l3_status', l3_status, count(*) FROM x WHERE l3_status <> 'ok' GROUP BY ALL UNION ALL SELECT 'all', 'ok', count(*) FROM x WHERE l1_status = 'ok' AND l3_status = 'ok'")
def strict_status(spark, sf):
    """Failures by layer and status, and the rows that pass in strict mode."""
    rows = table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 37 == 0, "failed:timeout").otherwise("ok").alias("l1_status"), F.when(F.col("l_partkey") % 41 == 0, "error:value").otherwise("ok").alias("l3_status"))
    good, bad = evidence.strict(rows, ["l1_status", "l3_status"])
    return bad.unionByName(good.agg(F.count("*").alias("n")).select(F.lit("all").alias("layer"), F.lit("ok").alias("status"), "n"))


@query("target_metadata", "SELECT s_suppkey, coalesce(nullif(concat_ws(' ', n_name, r_name), ''), CAST(s_suppkey AS VARCHAR)) AS text FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND s_suppkey % 4 <> 0 LEFT JOIN region ON n_regionkey = r_regionkey")
def target_metadata(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    geo = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    meta = s.filter("s_suppkey % 4 <> 0").join(geo, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name", "r_name")
    return evidence.described(s.select("s_suppkey"), meta, key="s_suppkey", parts=["n_name", "r_name"])


@query("library_activity", f"WITH {PAIRS}, a AS (SELECT DISTINCT key FROM cl WHERE label = 1 AND target_id = 1) SELECT p_partkey AS key, CASE WHEN a.key IS NULL THEN 0 ELSE 1 END AS y FROM part LEFT JOIN a ON p_partkey = a.key")
def library_activity(spark, sf):
    """Activity of every library row for one target."""
    library = table(spark, sf, "part").select(F.col("p_partkey").alias("key"))
    return evidence.activity(library, clean(spark, sf).filter("label = 1 and target_id = 1"), key="key")
