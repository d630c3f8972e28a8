"""Summaries of metrics, cascade selection and fusion."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import rounded
from ..functions.session import saved
from ..operators import fusion, ranking, stats
from .q_rank import LABELED, METRICS_SQL, auc_sql, early_sql, metrics
from .views import PS, pair_scores, r, table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


METRICS = ["auc_l2_labeled", "auc_final4_labeled", "recall_at_1pct_l2", "recall_at_1pct_final4", "observed_enrichment_at_1pct_l2", "observed_enrichment_at_1pct_final4", "gate_pass_rate"]
LONG = f"""
m AS ({METRICS_SQL}),
lg AS (SELECT target_id, metric, value FROM (UNPIVOT (SELECT target_id, {', '.join(f'CAST({x} AS DOUBLE) AS {x}' for x in METRICS)} FROM m) ON {', '.join(METRICS)} INTO NAME metric VALUE value))"""
FIVE = f"""n, {r("mean", 6)} AS mean, {r("q1", 6)} AS q1, {r("median", 6)} AS median, {r("q3", 6)} AS q3"""
#: The same with ties half to even, whatever the last bits: as whole multiples of 1e-11 first.
FIVE_EXACT = ", ".join(["n", *[f"round_even(round_even({c} * 100000000000.0::DOUBLE, 0) / 100000.0::DOUBLE, 0) / 1000000.0::DOUBLE AS {c}" for c in ("mean", "q1", "median", "q3")]])
FIVE_AGG = "count(*) AS n, avg(value) AS mean, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3"


def long(spark, sf):
    return stats.long_metrics(metrics(spark, sf), METRICS)


@query(
    "metrics_by_tier",
    f"""WITH {LONG}, t AS (SELECT lg.*, n_labeled_positive >= 200 AND n_labeled_negative >= 200 AS strict FROM lg JOIN m USING (target_id))
SELECT tier, metric, {FIVE} FROM (
  SELECT 'all' AS tier, metric, {FIVE_AGG} FROM t GROUP BY metric UNION ALL SELECT 'strict', metric, {FIVE_AGG} FROM t WHERE strict GROUP BY metric)""",
)
def metrics_by_tier(spark, sf):
    m = saved(metrics(spark, sf), "metrics")
    strict = m.filter("n_labeled_positive >= 200 and n_labeled_negative >= 200")
    parts = [stats.five_numbers(stats.long_metrics(x, METRICS)).withColumn("tier", F.lit(name)) for name, x in (("all", m), ("strict", strict))]
    return parts[0].unionByName(parts[1])


@query("metric_groups", f"WITH {LONG} SELECT target_id % 4 AS grp, metric, {FIVE_EXACT} FROM (SELECT target_id % 4 AS target_id, metric, {FIVE_AGG} FROM lg GROUP BY ALL)")
def metric_groups(spark, sf):
    rows = long(spark, sf).withColumn("grp", F.col("target_id") % 4)
    return stats.five_numbers(rows, ["grp", "metric"])


ORACLES["metric_groups"] = f"WITH {LONG}, x AS (SELECT target_id % 4 AS grp, metric, value FROM lg) SELECT grp, metric, {FIVE_EXACT} FROM (SELECT grp, metric, {FIVE_AGG} FROM x GROUP BY ALL)"


@query("upper_medians", f"WITH {LONG}, x AS (SELECT metric, value, row_number() OVER (PARTITION BY metric ORDER BY value) - 1 AS rn, count(*) OVER (PARTITION BY metric) AS n FROM lg) SELECT metric, max(n) AS n, max(value) FILTER (rn = n // 2) AS upper_median, min(value) AS least, max(value) AS largest FROM x GROUP BY metric")
def upper_medians(spark, sf):
    return stats.upper_median(long(spark, sf), "value", ["metric"])


@query(
    "bootstrap_median_ci",
    f"""WITH {LONG}, x AS (SELECT metric, value, row_number() OVER (PARTITION BY metric ORDER BY target_id) - 1 AS place, count(*) OVER (PARTITION BY metric) AS n FROM lg),
d0 AS (SELECT x.metric, rep, n, (42::BIGINT * 1000003 + rep::BIGINT * 65599 + place::BIGINT * 48271 + 1) % 2147483647 AS a FROM x, range(1, 2001) t(rep)),
d1 AS (SELECT metric, rep, n, (a * a % 2147483647 + a * 16807 + 11) % 2147483647 AS a FROM d0),
d2 AS (SELECT metric, rep, n, (a * a % 2147483647 + a * 16807 + 1013) % 2147483647 AS a FROM d1),
d AS (SELECT metric, rep, (a * a % 2147483647 + a * 16807 + 104729) % 2147483647 % n AS pick FROM d2),
md AS (SELECT d.metric, rep, median(x.value) AS m FROM d JOIN x ON d.metric = x.metric AND d.pick = x.place GROUP BY ALL)
SELECT metric, {r("quantile_cont(m, 0.025)", 6)} AS low, {r("quantile_cont(m, 0.975)", 6)} AS high FROM md GROUP BY metric""",
)
def bootstrap_median_ci(spark, sf):
    return stats.bootstrap_median(long(spark, sf))


@query("score_histogram", f"WITH {PS}, h AS (SELECT least(19, CAST(floor(final_score * 20) AS INTEGER)) AS bin, count(*) AS n FROM ps WHERE final_score BETWEEN 0 AND 1 GROUP BY 1) SELECT CAST(b AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(20) t(b) LEFT JOIN h ON bin = b")
def score_histogram(spark, sf):
    return stats.histogram(pair_scores(spark, sf), "final_score")


@query("bucket_medians", f"WITH m AS ({METRICS_SQL}) SELECT CAST(n_labeled_positive >= 195 AS INT) + CAST(n_labeled_positive >= 200 AS INT) + CAST(n_labeled_positive >= 210 AS INT) AS bucket, count(*) AS n, median(auc_l2_labeled) AS auc, median(recall_at_1pct_l2) AS recall, median(observed_enrichment_at_1pct_l2) AS enrichment FROM m GROUP BY 1")
def bucket_medians(spark, sf):
    b = stats.bucket(F.col("n_labeled_positive"), (195, 200, 210))
    rows = metrics(spark, sf).select(b.alias("bucket"), F.col("auc_l2_labeled").alias("auc"), F.col("recall_at_1pct_l2").alias("recall"), F.col("observed_enrichment_at_1pct_l2").alias("enrichment"))
    return stats.medians(rows, ["auc", "recall", "enrichment"], ["bucket"])


@query("pearson", f"WITH {PS} SELECT target_id, count(*) AS n, {r('corr(l2, final_score)', 6)} AS correlation FROM ps GROUP BY 1")
def pearson(spark, sf):
    return stats.pearson(pair_scores(spark, sf), "l2", "final_score", ["target_id"])


@query(
    "spearman",
    f"""WITH {PS}, k AS (SELECT target_id, rank() OVER (PARTITION BY target_id ORDER BY l2) + (count(*) OVER (PARTITION BY target_id, l2) - 1) / 2.0::DOUBLE AS a,
  rank() OVER (PARTITION BY target_id ORDER BY final_score) + (count(*) OVER (PARTITION BY target_id, final_score) - 1) / 2.0::DOUBLE AS b FROM ps)
SELECT target_id, count(*) AS n, {r('corr(a, b)', 6)} AS correlation FROM k GROUP BY 1""",
)
def spearman(spark, sf):
    return stats.spearman(pair_scores(spark, sf), "l2", "final_score", ["target_id"])


@query("threshold_shares", f"WITH {PS} SELECT target_id, count(*) AS n, {', '.join(f'''{r(f'avg(CAST(final_score >= {x}::DOUBLE AS INT))', 6)} AS share_{int(float(x) * 100)}''' for x in ('0.5', '0.7', '0.8', '0.9'))}, {r('avg(CAST(final_score < 0.5::DOUBLE AS INT))', 6)} AS share_reversed FROM ps GROUP BY 1")
def threshold_shares(spark, sf):
    return stats.threshold_shares(pair_scores(spark, sf), "final_score", (0.5, 0.7, 0.8, 0.9), by=["target_id"])


@query(
    "funnel_survival",
    f"""WITH {PS}, a AS (SELECT *, l1 >= 0.45::DOUBLE AS s1, count(*) FILTER (l1 >= 0.45::DOUBLE) OVER (PARTITION BY target_id) AS n1 FROM ps),
b AS (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY s1 DESC, l2 DESC, candidate_index) AS k, label_role = 'heldout_positive' AS pos FROM a),
d AS (SELECT *, s1 AND k <= greatest(1, round_even(n1 * 0.10::DOUBLE, 0)) AS s2, l3 >= 0.5::DOUBLE AS s3 FROM b)
SELECT target_id, {r('avg(CAST(s1 AS INT))', 3)} AS l1_keep, {r('count(*) FILTER (pos AND s1)::DOUBLE / count(*) FILTER (pos)', 3)} AS l1_positives, {r('count(*) FILTER (pos AND s2)::DOUBLE / count(*) FILTER (pos)', 3)} AS l2_positives,
       {r('avg(CAST(s3 AS INT))', 3)} AS l3_keep, {r('count(*) FILTER (pos AND s3)::DOUBLE / count(*) FILTER (pos)', 3)} AS l3_positives FROM d GROUP BY 1""",
)
def funnel_survival(spark, sf):
    return stats.funnel(pair_scores(spark, sf), positive=ranking.is_positive())


@query("separation", f"WITH {PS} SELECT target_id, {r('''avg(CASE WHEN label_role = 'heldout_positive' THEN l4 END) - avg(CASE WHEN label_role = 'heldout_negative' THEN l4 END)''', 6)} AS separation, {r('stddev_samp(l4)', 6)} AS l4_std, stddev_pop(l4) > 0 AS varies FROM ps GROUP BY 1")
def separation(spark, sf):
    mean = lambda role: F.avg(F.when(F.col("label_role") == role, F.col("l4")))
    return pair_scores(spark, sf).groupBy("target_id").agg(
        rounded(mean(ranking.POSITIVE) - mean(ranking.NEGATIVE), 6).alias("separation"), rounded(F.stddev_samp("l4"), 6).alias("l4_std"), (F.stddev_pop("l4") > 0).alias("varies")
    )


@query(
    "pair_losses",
    f"""WITH {PS}, lw AS (SELECT target_id, {r('''max(t) + ln(sum(exp(final_score - t))) - avg(CASE WHEN label_role = 'heldout_positive' THEN final_score END)''', 6)} AS list_loss FROM (SELECT *, max(final_score) OVER (PARTITION BY target_id) AS t FROM ps) GROUP BY 1),
a AS (SELECT target_id, final_score, row_number() OVER (PARTITION BY target_id ORDER BY candidate_index) AS k FROM ps WHERE label_role = 'heldout_positive'),
b AS (SELECT target_id, final_score, row_number() OVER (PARTITION BY target_id ORDER BY candidate_index) AS k FROM ps WHERE label_role = 'heldout_negative'),
pw AS (SELECT a.target_id, count(*) AS n_pairs, {r('avg(ln(1 + exp(b.final_score - a.final_score)))', 6)} AS pair_loss FROM a JOIN b ON a.target_id = b.target_id AND a.k = b.k GROUP BY 1)
SELECT lw.target_id, list_loss, n_pairs, pair_loss FROM lw JOIN pw USING (target_id)""",
)
def pair_losses(spark, sf):
    """List-wise loss over pools, and pair-wise loss over positives paired with negatives in order."""
    rows = pair_scores(spark, sf)
    number = F.row_number().over(W.partitionBy("target_id").orderBy("candidate_index"))
    side = lambda role, name: rows.filter(F.col("label_role") == role).select("target_id", number.alias("_k"), F.col("final_score").alias(name))
    pairs = side(ranking.POSITIVE, "better").join(side(ranking.NEGATIVE, "worse"), ["target_id", "_k"])
    return stats.listwise_loss(rows, "final_score", ranking.is_positive()).withColumnRenamed("loss", "list_loss").join(stats.pairwise_loss(pairs, "better", "worse").withColumnRenamed("loss", "pair_loss"), "target_id")


@query("hit_survivors", f"WITH {PS}, k AS (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY l2 DESC, candidate_index) AS rk FROM ps) SELECT count(*) AS kept, count(*) FILTER (final_score >= 0.5::DOUBLE) AS survivors, count(DISTINCT target_id) AS targets FROM k WHERE rk <= 100")
def hit_survivors(spark, sf):
    top = ranking.top_n(pair_scores(spark, sf), "l2", 100)
    return top.agg(F.count("*").alias("kept"), F.count_if(F.col("final_score") >= 0.5).alias("survivors"), F.countDistinct("target_id").alias("targets"))


# -- cascade and fusion -------------------------------------------------------------------------

STATUSES = ("ok", "ok", "ok", "skipped_hac", "dock_timeout", "dock_no_score")


def docking(spark, sf, n: int = 60):
    """Results for each target's best rows: status from the order, size from the part."""
    top = ranking.top_n(pair_scores(spark, sf), "l2", n, name="selection_rank")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("part_key"), F.col("p_size").alias("heavy_atoms"))
    status = F.element_at(F.array(*[F.lit(s) for s in STATUSES]), ((F.col("candidate_index") % 6) + 1).cast("int"))
    rows = top.join(part, "part_key").select("target_id", "candidate_index", "selection_rank", status.alias("status"), (-F.col("price") / 10000).alias("affinity"), "heavy_atoms")
    return fusion.screened(rows, 45)


DOCK = f"""{PS},
dk0 AS (SELECT target_id, candidate_index, part_key, price, row_number() OVER (PARTITION BY target_id ORDER BY l2 DESC, candidate_index) AS selection_rank FROM ps),
dk AS (SELECT target_id, candidate_index, selection_rank, CASE WHEN p_size > 45 THEN 'skipped_size' ELSE ['ok', 'ok', 'ok', 'skipped_hac', 'dock_timeout', 'dock_no_score'][candidate_index % 6 + 1] END AS status, -price / 10000 AS affinity, p_size AS heavy_atoms
       FROM dk0 JOIN part ON part_key = p_partkey WHERE selection_rank <= 60),
at0 AS (SELECT ps.*, coalesce(status, 'not_selected') AS docking_status, CASE WHEN status = 'ok' THEN affinity END AS docking_affinity,
              CASE WHEN status = 'ok' THEN {r('affinity / heavy_atoms', 4)} END AS ligand_efficiency, selection_rank
       FROM ps LEFT JOIN dk USING (target_id, candidate_index)),
fu AS (SELECT *, CASE WHEN ligand_efficiency IS NOT NULL THEN l2 + 0.30::DOUBLE * (stddev_pop(l2) OVER w + 1e-9) * ((-ligand_efficiency - avg(-ligand_efficiency) OVER w) / (stddev_pop(-ligand_efficiency) OVER w + 1e-9)) ELSE l2 END AS fused_raw
       FROM at0 WINDOW w AS (PARTITION BY target_id)),
fz AS (SELECT *, {r('fused_raw', 6)} AS fused_score FROM fu)"""


def attached(spark, sf):
    return fusion.attach(pair_scores(spark, sf), docking(spark, sf))


def fused(spark, sf):
    return attached(spark, sf).withColumn("fused_score", rounded(fusion.corrected("l2", "ligand_efficiency"), 6))


@query("cascade_topn", f"WITH {PS} SELECT target_id, candidate_index, rk AS selection_rank FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY l2 DESC, candidate_index) AS rk FROM ps) WHERE rk <= 60")
def cascade_topn(spark, sf):
    return ranking.top_n(pair_scores(spark, sf), "l2", 60, name="selection_rank").select("target_id", "candidate_index", "selection_rank")


@query("topk_per_target", f"WITH {PS} SELECT target_id, part_key, {r('final_score', 4)} AS score, rk AS rank FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY final_score DESC, candidate_index) AS rk FROM ps) WHERE rk <= 20")
def topk_per_target(spark, sf):
    return ranking.top_n(pair_scores(spark, sf), "final_score", 20).select("target_id", "part_key", rounded(F.col("final_score"), 4).alias("score"), "rank")


@query("status_counts", f"WITH {DOCK} SELECT docking_status, count(*) AS n FROM at0 GROUP BY 1")
def status_counts(spark, sf):
    return attached(spark, sf).groupBy("docking_status").agg(F.count("*").alias("n"))


@query("fusion_le", f"WITH {DOCK} SELECT target_id, candidate_index, docking_status, ligand_efficiency, fused_score FROM fz")
def fusion_le(spark, sf):
    return fused(spark, sf).select("target_id", "candidate_index", "docking_status", "ligand_efficiency", "fused_score")


@query(
    "fusion_table",
    f"""WITH {DOCK}, n AS (SELECT *, CASE WHEN ligand_efficiency IS NOT NULL AND max(ligand_efficiency) OVER w > min(ligand_efficiency) OVER w THEN {r('(max(ligand_efficiency) OVER w - ligand_efficiency) / (max(ligand_efficiency) OVER w - min(ligand_efficiency) OVER w)', 4)} ELSE 0 END AS le_norm,
  CASE WHEN ligand_efficiency IS NOT NULL THEN row_number() OVER (PARTITION BY target_id ORDER BY ligand_efficiency ASC NULLS LAST, candidate_index) END AS dock_rank FROM at0 WINDOW w AS (PARTITION BY target_id))
SELECT target_id, candidate_index, le_norm::DOUBLE AS le_norm, dock_rank FROM n WHERE docking_status <> 'not_selected'""",
)
def fusion_table(spark, sf):
    """Merged results: normalised efficiency and the rank of the second stage alone."""
    rows = ranking.re_rank(attached(spark, sf), "ligand_efficiency").withColumn("le_norm", fusion.le_norm(F.col("ligand_efficiency"), ["target_id"]))
    return rows.filter("docking_status <> 'not_selected'").select("target_id", "candidate_index", "le_norm", "dock_rank")


@query(
    "fusion_rank",
    f"""WITH {DOCK} SELECT target_id, candidate_index, -(row_number() OVER (PARTITION BY target_id ORDER BY l2 DESC, candidate_index) + row_number() OVER (PARTITION BY target_id ORDER BY -ligand_efficiency DESC NULLS LAST, candidate_index)) AS rank_sum FROM at0""",
)
def fusion_rank(spark, sf):
    rows = attached(spark, sf).withColumn("_neg", -F.col("ligand_efficiency"))
    return rows.select("target_id", "candidate_index", fusion.rank_sum("l2", "_neg").cast("long").alias("rank_sum"))


@query(
    "fusion_zsum",
    f"""WITH {DOCK} SELECT target_id, candidate_index, {r('(l2 - avg(l2) OVER w) / (stddev_pop(l2) OVER w + 1e-9) + (-coalesce(ligand_efficiency, 0) - avg(-coalesce(ligand_efficiency, 0)) OVER w) / (stddev_pop(-coalesce(ligand_efficiency, 0)) OVER w + 1e-9)', 6)} AS z_sum FROM at0 WINDOW w AS (PARTITION BY target_id)""",
)
def fusion_zsum(spark, sf):
    return attached(spark, sf).select("target_id", "candidate_index", rounded(fusion.z_sum("l2", "ligand_efficiency"), 6).alias("z_sum"))


@query("fusion_eliminate", f"WITH {DOCK}, ps2 AS (SELECT *, coalesce(-ligand_efficiency, -1e9) AS cut FROM at0) {auc_sql('cut', LABELED, 6).replace('FROM ps ', 'FROM ps2 ')}")
def fusion_eliminate(spark, sf):
    """AUC of the baseline that drops everything without evidence to the bottom."""
    return ranking.auc(attached(spark, sf).withColumn("cut", fusion.eliminated("ligand_efficiency")), "cut")


STATUS_OF = {"l1_status": ("candidate_index", 37), "l3_status": ("part_key", 41)}


@query(
    "metrics_per_target",
    f"""WITH {DOCK}, m AS ({METRICS_SQL}), s AS (SELECT target_id, {', '.join(f"{r(f'1.0 - avg(CASE WHEN {c} % {n} = 0 THEN 0.0 ELSE 1.0 END)', 8)} AS {s}_failure_rate" for s, (c, n) in STATUS_OF.items())} FROM ps GROUP BY 1)
SELECT m.*, s.* EXCLUDE (target_id), a.auc_fused_labeled, e.recall_at_1pct_fused, e.observed_enrichment_at_1pct_fused FROM m JOIN s USING (target_id)
JOIN ({auc_sql('fused_score', LABELED, 6, 'auc_fused_labeled').replace('FROM ps ', 'FROM fz ')}) a USING (target_id) JOIN ({early_sql('fused_score', 'fused').replace('FROM ps)', 'FROM fz)')}) e USING (target_id)""",
)
def metrics_per_target(spark, sf):
    """All metrics of a target: base and fused scores, failure rates of the layers, and the gate."""
    rows = fused(spark, sf).withColumns({s: F.when(F.col(c) % n == 0, "failed:missing").otherwise("ok") for s, (c, n) in STATUS_OF.items()})
    rows = rows.withColumn("gate_status", F.when((F.col("l2") < 0.2) & (F.col("l3") < 0.5), "FAIL").otherwise("PASS"))
    return ranking.target_metrics(rows, scores={"l2": "l2", "final_score": "final4", "fused_score": "fused"}, statuses=list(STATUS_OF), gate="gate_status")


def before_after(score):
    return f"SELECT a.target_id, a.auc, e.recall_at_1pct_x AS recall FROM ({auc_sql(score, LABELED, 6)}) a JOIN ({early_sql(score, 'x')}) e USING (target_id)".replace("FROM ps ", "FROM fz ").replace("FROM ps)", "FROM fz)")


@query("fusion_before_after", f"WITH {DOCK} SELECT 'before' AS stage, * FROM ({before_after('final_score')}) UNION ALL SELECT 'after', * FROM ({before_after('fused_score')})")
def fusion_before_after(spark, sf):
    """Both scores in one pass over the rows."""
    m = ranking.target_metrics(fused(spark, sf), scores={"final_score": "before", "fused_score": "after"})
    stage = lambda s: F.struct(F.lit(s).alias("stage"), F.col(f"auc_{s}_labeled").alias("auc"), F.col(f"recall_at_1pct_{s}").alias("recall"))
    return m.select("target_id", F.explode(F.array(stage("before"), stage("after"))).alias("_x")).select("target_id", "_x.*")


VALID = "docking_status IN ('ok', 'not_selected')"


@query("page_view", f"WITH {DOCK}, v AS (SELECT *, target_id * 100000 + candidate_index AS pos FROM fz WHERE {VALID}) SELECT target_id, candidate_index, fused_score, (SELECT count(*) FROM v) AS total FROM v ORDER BY fused_score DESC, pos LIMIT 50 OFFSET 100")
def page_view(spark, sf):
    rows = fused(spark, sf).withColumn("pos", F.col("target_id") * 100000 + F.col("candidate_index"))
    return ranking.page(rows, valid=F.expr(VALID), score="fused_score", position="pos", view="ranked", offset=100, limit=50).select("target_id", "candidate_index", "fused_score", "total")


@query("page_keyset", f"WITH {DOCK}, v AS (SELECT *, target_id * 100000 + candidate_index AS pos, row_number() OVER (ORDER BY fused_score DESC, target_id * 100000 + candidate_index) - 1 AS place FROM fz WHERE {VALID}) SELECT CAST((place - 1000) // 50 AS INTEGER) AS page, target_id, candidate_index, fused_score FROM v WHERE place BETWEEN 1000 AND 1149")
def page_keyset(spark, sf):
    """Three pages of the ranked view from place 1,000 on: the first by counts of ranges, the next ones by the last row before."""
    rows = saved(fused(spark, sf).filter(VALID).select("target_id", "candidate_index", "fused_score", (F.col("target_id") * 100000 + F.col("candidate_index")).alias("pos")), "ranked")
    start = ranking.page_start(rows, "fused_score", "pos", 1000)
    if start is None:
        return rows.limit(0).select(F.lit(0).alias("page"), "target_id", "candidate_index", "fused_score")
    pages = []
    for n in range(3):
        page = ranking.page_from(rows, "fused_score", "pos", start, 50, after=n > 0)
        pages.append(page.withColumn("page", F.lit(n)))
        last = page.orderBy(F.col("fused_score"), F.col("pos").desc()).first()  # of 50 rows
        if last is None:
            break
        start = last["fused_score"], last["pos"]
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p)
    return out.select("page", "target_id", "candidate_index", "fused_score")


@query("result_summary", f"WITH {DOCK} SELECT count(*) AS n_rows, count(*) FILTER ({VALID}) AS n_ranked, count(*) FILTER (NOT {VALID}) AS n_failed, count(*) FILTER (docking_status = 'ok') AS n_docked, count(ligand_efficiency) > 0 AS has_fused FROM fz")
def result_summary(spark, sf):
    """One pass: rows, ranked, failed, successful; and whether the fused column decides the order."""
    ok = F.expr(VALID)
    return fused(spark, sf).agg(
        F.count("*").alias("n_rows"), F.count_if(ok).alias("n_ranked"), F.count_if(~ok).alias("n_failed"), F.count_if(F.col("docking_status") == "ok").alias("n_docked"), (F.count("ligand_efficiency") > 0).alias("has_fused")
    )


@query(
    "ranking_choice",
    f"""WITH {DOCK}, s AS (SELECT 'fused' AS run, target_id, fused_score AS s FROM fz UNION ALL SELECT 'all_missing', target_id, final_score FROM fz UNION ALL SELECT 'no_column', target_id, final_score FROM fz)
SELECT run, target_id, CAST(sum(CAST(round_even(s * 10000, 0) AS BIGINT)) AS BIGINT) AS total FROM s GROUP BY 1, 2""",
)
def ranking_choice(spark, sf):
    """The column that decides the order: fused where it has values, else the base score."""
    rows = fused(spark, sf)
    runs_ = {"fused": rows, "all_missing": rows.withColumn("fused_score", F.lit(None).cast("double")), "no_column": rows.drop("fused_score")}
    out = None
    for name, df in runs_.items():
        part = fusion.ranking_score(df).groupBy("target_id").agg(F.sum(F.rint(F.col("ranking_score") * 10000).cast("long")).alias("total")).withColumn("run", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("evidence_rows", f"WITH {DOCK} SELECT CAST(target_id AS VARCHAR) AS target, CAST(candidate_index AS INTEGER) AS candidate, label_role AS role, {r('coalesce(fused_score, final_score)', 4)} AS ranking_score, docking_status AS status FROM fz WHERE docking_status = 'ok'")
def evidence_rows(spark, sf):
    """The output contract: names, order and types."""
    return fused(spark, sf).filter("docking_status = 'ok'").select(
        F.col("target_id").cast("string").alias("target"), F.col("candidate_index").cast("int").alias("candidate"), F.col("label_role").alias("role"), rounded(F.coalesce("fused_score", "final_score"), 4).alias("ranking_score"), F.col("docking_status").alias("status")
    )


@query("progress", f"WITH {PS}, c AS (SELECT target_id, count(*) AS n FROM ps GROUP BY 1) SELECT target_id, sum(n) OVER w::BIGINT AS rows_done, count(*) OVER w AS targets_done FROM c WINDOW w AS (ORDER BY target_id ROWS UNBOUNDED PRECEDING)".replace("sum(n) OVER w::BIGINT", "CAST(sum(n) OVER w AS BIGINT)"))
def progress(spark, sf):
    """Running totals over targets (one row each)."""
    per = pair_scores(spark, sf).groupBy("target_id").agg(F.count("*").alias("n"))
    w = W.partitionBy(F.lit(0)).orderBy("target_id").rowsBetween(W.unboundedPreceding, 0)
    return per.select("target_id", F.sum("n").over(w).alias("rows_done"), F.count("*").over(w).alias("targets_done"))


@query(
    "fixture_pick",
    """WITH t AS (SELECT p_partkey AS key, p_size AS heavy FROM part),
c AS (SELECT key, 0 AS pr, key AS o FROM (SELECT key FROM t WHERE key % 7 = 0 ORDER BY key LIMIT 2) UNION ALL SELECT key, 1, key FROM (SELECT key FROM t ORDER BY heavy DESC, key LIMIT 1)
  UNION ALL SELECT key, 2, key FROM (SELECT key FROM t WHERE key % 11 = 0 ORDER BY key LIMIT 1) UNION ALL SELECT key, 3, key FROM t)
SELECT key, ['positive', 'heaviest', 'flagged', 'normal'][CAST(pr + 1 AS INTEGER)] AS category FROM (SELECT key, min(pr) AS pr FROM c GROUP BY key) ORDER BY pr, key LIMIT 20""",
)
def fixture_pick(spark, sf):
    """A varied fixture: two positives, the heaviest row, the first flagged row, then by order."""
    t = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("heavy"))
    picks = [
        (t.filter("key % 7 = 0").orderBy("key").limit(2), 0), (t.orderBy(F.col("heavy").desc(), "key").limit(1), 1), (t.filter("key % 11 = 0").orderBy("key").limit(1), 2), (t.orderBy("key").limit(20), 3)
    ]
    every = None
    for df, pr in picks:
        df = df.select("key", F.lit(pr).alias("pr"))
        every = df if every is None else every.union(df)
    name = F.element_at(F.array(*[F.lit(x) for x in ("positive", "heaviest", "flagged", "normal")]), F.col("pr") + 1)
    return every.groupBy("key").agg(F.min("pr").alias("pr")).orderBy("pr", "key").limit(20).select("key", name.alias("category"))


@query("library_rank", f"WITH {PS} SELECT target_id, candidate_index, rk AS rank, {r('100.0::DOUBLE * rk / n', 4)} AS percent FROM (SELECT *, rank() OVER (ORDER BY final_score DESC) AS rk, count(*) OVER () AS n FROM ps) WHERE label_role = 'heldout_positive'")
def library_rank(spark, sf):
    """Place of every known active in the whole table."""
    rows = pair_scores(spark, sf)
    n = rows.agg(F.count("*").alias("n"))
    ranked = ranking.overall_rank(rows, "final_score").filter(ranking.is_positive()).crossJoin(F.broadcast(n))
    return ranked.select("target_id", "candidate_index", "rank", rounded(F.lit(100.0) * F.col("rank") / F.col("n"), 4).alias("percent"))


@query("extremes", f"WITH m AS ({METRICS_SQL}) SELECT * FROM (SELECT 'best' AS side, target_id, auc_l2_labeled AS auc FROM m ORDER BY auc_l2_labeled DESC, target_id LIMIT 5) UNION ALL SELECT * FROM (SELECT 'worst', target_id, auc_l2_labeled FROM m ORDER BY auc_l2_labeled, target_id LIMIT 5)")
def extremes(spark, sf):
    """Five best and five worst targets."""
    m = ranking.auc(pair_scores(spark, sf), "l2")
    best = m.orderBy(F.col("auc").desc(), "target_id").limit(5).withColumn("side", F.lit("best"))
    return best.unionByName(m.orderBy("auc", "target_id").limit(5).withColumn("side", F.lit("worst")))


RUNS = f"""a AS (WITH {PS} SELECT target_id, auc AS auc_a FROM ({auc_sql('l2', LABELED, 6)})), b AS (WITH {PS} SELECT target_id, auc AS auc_b FROM ({auc_sql('final_score', LABELED, 6)})),
ab AS (SELECT *, target_id % 10 AS support FROM a JOIN b USING (target_id))"""


def runs(spark, sf):
    rows = pair_scores(spark, sf)
    return ranking.auc(rows, "l2", name="auc_a").join(ranking.auc(rows, "final_score", name="auc_b"), "target_id").withColumn("support", F.col("target_id") % 10)


@query("run_compare", f"WITH {RUNS} SELECT count(*) AS n, count(*) FILTER (auc_b > auc_a) AS improved, count(*) FILTER (auc_a < 0.5 AND auc_b >= 0.5) AS reversed_fixed, {r('median(auc_b - auc_a)', 6)} AS median_delta FROM ab")
def run_compare(spark, sf):
    d = F.col("auc_b") - F.col("auc_a")
    return runs(spark, sf).agg(F.count("*").alias("n"), F.count_if(d > 0).alias("improved"), F.count_if((F.col("auc_a") < 0.5) & (F.col("auc_b") >= 0.5)).alias("reversed_fixed"), rounded(F.median(d), 6).alias("median_delta"))


@query(
    "routing_ceiling",
    f"""WITH {RUNS}, o AS (SELECT median(greatest(auc_a, auc_b)) AS ceiling, median(auc_a) AS base, count(*) FILTER (auc_b > auc_a + 0.02::DOUBLE) AS b_wins, count(*) FILTER (auc_a > auc_b + 0.02::DOUBLE) AS a_wins, count(*) AS n FROM ab),
t AS (SELECT cut, median(CASE WHEN support < cut THEN auc_b ELSE auc_a END) AS routed FROM ab, (VALUES (2), (5), (8)) v(cut) GROUP BY cut)
SELECT cut, {r('ceiling', 6)} AS ceiling, b_wins, a_wins, n - b_wins - a_wins AS ties, {r('routed', 6)} AS routed, CASE WHEN ceiling <> base THEN {r('(routed - base) / (ceiling - base)', 6)} ELSE 0 END AS recovered FROM o, t""",
)
def routing_ceiling(spark, sf):
    """What a perfect choice between two models would give, and what a support threshold recovers."""
    ab = runs(spark, sf)
    a, b = F.col("auc_a"), F.col("auc_b")
    o = ab.agg(F.median(F.greatest(a, b)).alias("ceiling"), F.median(a).alias("base"), F.count_if(b > a + 0.02).alias("b_wins"), F.count_if(a > b + 0.02).alias("a_wins"), F.count("*").alias("n"))
    t = ab.withColumn("cut", F.explode(F.array(F.lit(2), F.lit(5), F.lit(8)))).groupBy("cut").agg(F.median(F.when(F.col("support") < F.col("cut"), b).otherwise(a)).alias("routed"))
    gain = F.when(F.col("ceiling") != F.col("base"), rounded((F.col("routed") - F.col("base")) / (F.col("ceiling") - F.col("base")), 6)).otherwise(0.0)
    return t.crossJoin(F.broadcast(o)).select("cut", rounded(F.col("ceiling"), 6).alias("ceiling"), "b_wins", "a_wins", (F.col("n") - F.col("b_wins") - F.col("a_wins")).alias("ties"), rounded(F.col("routed"), 6).alias("routed"), gain.alias("recovered"))


@query("best_method", f"WITH {RUNS} SELECT target_id, CASE WHEN auc_b > auc_a THEN 'b' ELSE 'a' END AS method, greatest(auc_a, auc_b) AS auc FROM ab")
def best_method(spark, sf):
    """Diagnostic only: the method that did better is known after the evaluation."""
    pairs = F.array(F.struct(F.col("auc_a").alias("auc"), F.lit("a").alias("method")), F.struct(F.col("auc_b").alias("auc"), F.lit("b").alias("method")))
    long = runs(spark, sf).select("target_id", F.explode(pairs).alias("_x")).select("target_id", "_x.*")
    w = W.partitionBy("target_id").orderBy(F.col("auc").desc(), "method")
    return long.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("target_id", "method", "auc")
