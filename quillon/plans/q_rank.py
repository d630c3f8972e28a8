"""Scores, gate and ranking metrics over candidate scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import layers, scalar
from ..operators import ranking
from .views import DE, PS, descriptors, pair_scores, r

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


GROUPS = """
g0 AS (SELECT target_id, {score} AS score, count(*) AS n, count(*) FILTER (label_role = 'heldout_positive') AS p FROM ps {where} GROUP BY ALL),
g AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY target_id ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(n) OVER (PARTITION BY target_id) AS total, sum(p) OVER (PARTITION BY target_id) AS positives FROM g0)"""
LABELED = "WHERE label_role <> 'unlabeled_background'"


def auc_sql(score: str, where: str, digits: int, name: str = "auc") -> str:
    """Rank-sum AUC by average ranks."""
    return f"""
SELECT t.target_id, {r("(s - p * (p + 1) / 2.0::DOUBLE) / (p * (n - p))", digits)} AS {name}
FROM (SELECT DISTINCT target_id FROM ps) t LEFT JOIN (
  SELECT target_id, sum(CASE WHEN label_role = 'heldout_positive' THEN rk END) AS s, count(*) FILTER (label_role = 'heldout_positive') AS p, count(*) AS n
  FROM (SELECT target_id, label_role, rank() OVER (PARTITION BY target_id ORDER BY {score}) + (count(*) OVER (PARTITION BY target_id, {score}) - 1) / 2.0::DOUBLE AS rk
        FROM ps {where})
  GROUP BY target_id) x ON t.target_id = x.target_id AND p > 0 AND p < n"""


def early_sql(score: str, name: str) -> str:
    return f"""
SELECT target_id, {r("hits::DOUBLE / p", 6)} AS recall_at_1pct_{name}, {r("(hits::DOUBLE / k) / (p::DOUBLE / n)", 6)} AS observed_enrichment_at_1pct_{name}
FROM (SELECT target_id, max(n) AS n, max(k) AS k, count(*) FILTER (label_role = 'heldout_positive') AS p, count(*) FILTER (label_role = 'heldout_positive' AND rk <= k) AS hits
      FROM (SELECT *, greatest(1, CAST(round_even(n * 0.01::DOUBLE, 0) AS INTEGER)) AS k
            FROM (SELECT *, count(*) OVER (PARTITION BY target_id) AS n, row_number() OVER (PARTITION BY target_id ORDER BY {score} DESC, candidate_index) AS rk FROM ps))
      GROUP BY target_id)"""


GATED = "gated AS (SELECT ps.*, CASE WHEN l2 < 0.2::DOUBLE THEN 1 ELSE 0 END + CASE WHEN l3 < 0.5::DOUBLE THEN 1 ELSE 0 END AS broken FROM ps)"
METRICS_SQL = f"""WITH {PS}, {GATED}
SELECT c.*, a.auc_l2_labeled, b.auc_final4_labeled, e.recall_at_1pct_l2, e.observed_enrichment_at_1pct_l2, f.recall_at_1pct_final4, f.observed_enrichment_at_1pct_final4
FROM (SELECT target_id, count(*) AS n_pool, count(*) FILTER (label_role = 'heldout_positive') AS n_labeled_positive,
             count(*) FILTER (label_role = 'heldout_negative') AS n_labeled_negative, count(*) FILTER (label_role = 'unlabeled_background') AS n_unlabeled_background,
             {r("avg(CASE WHEN broken < 2 THEN 1.0 ELSE 0.0 END)", 8)} AS gate_pass_rate,
             greatest(1, CAST(round_even(count(*) * 0.01::DOUBLE, 0) AS INTEGER)) AS top_k_1pct
      FROM gated GROUP BY target_id) c
JOIN ({auc_sql("l2", LABELED, 6, "auc_l2_labeled")}) a USING (target_id)
JOIN ({auc_sql("final_score", LABELED, 6, "auc_final4_labeled")}) b USING (target_id)
JOIN ({early_sql("l2", "l2")}) e USING (target_id)
JOIN ({early_sql("final_score", "final4")}) f USING (target_id)"""


def gated_scores(spark, sf):
    """Candidate scores with a gate on two layers; other evidence is at its clean value."""
    clean = {"admet": F.col("l3"), "alerts": F.lit(0), "severe": F.lit(0), "oral": F.lit(1.0), "herg": F.lit(0.0)}
    rows = pair_scores(spark, sf).withColumns(clean).withColumn("_reasons", layers.gate_reasons())
    status, _ = layers.gate(F.col("_reasons"))
    return rows.withColumn("gate_status", status).drop("_reasons", *clean)


def metrics(spark, sf):
    return ranking.target_metrics(gated_scores(spark, sf), scores={"l2": "l2", "final_score": "final4"}, gate="gate_status")


@query("screen_summary", METRICS_SQL)
def screen_summary(spark, sf):
    """Flagship: combine, gate, rank, and metrics for every target."""
    return metrics(spark, sf)


@query(
    "combine_weights",
    f"""WITH {PS}
SELECT target_id, candidate_index, final_score, {r("0.25::DOUBLE * l1 + 0.40::DOUBLE * l2 + 0.35::DOUBLE * l3", 4)} AS three_layer,
       {r("0.20::DOUBLE * l1 + 0.50::DOUBLE * l2 + 0.20::DOUBLE * l3", 4)} AS without_l4, {r("greatest(0.0::DOUBLE, least(1.0::DOUBLE, l4 * 1.2::DOUBLE))", 4)} AS chance,
       greatest(0.0::DOUBLE, least(1.0::DOUBLE, (price / 10000 - 4.0) / 5.0)) AS affinity
FROM ps""",
)
def combine_weights(spark, sf):
    rows = pair_scores(spark, sf)
    return rows.select(
        "target_id", "candidate_index", "final_score", scalar.combine(scalar.THREE_LAYER).alias("three_layer"), scalar.combine(scalar.WITHOUT_L4).alias("without_l4"),
        scalar.probability(F.col("l4") * 1.2).alias("chance"), scalar.affinity_norm(F.col("price") / 10000).alias("affinity"),
    )


def _q(name, score, where, digits, **kw):
    @query(name, f"WITH {PS} {auc_sql(score, where, digits)}")
    def run(spark, sf):
        return ranking.auc(pair_scores(spark, sf), score, digits=digits, **kw)


_q("auc_strict", "final_score", LABELED, 6)
_q("auc_full_pool", "final_score", "", 6, negatives="all")


@query("auc_pairwise", f"WITH {PS} SELECT target_id, coalesce(auc, 0) AS auc FROM ({auc_sql('-price', LABELED, 4)})")
def auc_pairwise(spark, sf):
    """Lower is better: the sign of the score is turned; a target without both classes has 0."""
    return ranking.auc(pair_scores(spark, sf).withColumn("energy", -F.col("price")), "energy", digits=4, empty=0.0)


@query(
    "recall_enrichment",
    f"""WITH {PS}
SELECT target_id, n AS n_pool, k AS top_k, p AS n_positive, hits, {r("hits::DOUBLE / p", 6)} AS recall, {r("(hits::DOUBLE / k) / (p::DOUBLE / n)", 6)} AS enrichment
FROM (SELECT target_id, max(n) AS n, max(k) AS k, count(*) FILTER (label_role = 'heldout_positive') AS p, count(*) FILTER (label_role = 'heldout_positive' AND rk <= k) AS hits
      FROM (SELECT *, greatest(1, CAST(round_even(n * 0.05::DOUBLE, 0) AS INTEGER)) AS k
            FROM (SELECT *, count(*) OVER (PARTITION BY target_id) AS n, row_number() OVER (PARTITION BY target_id ORDER BY l2 DESC, candidate_index) AS rk FROM ps))
      GROUP BY target_id)""",
)
def recall_enrichment(spark, sf):
    return ranking.early_retrieval(pair_scores(spark, sf), "l2", fraction=0.05)


def within_sql(sizes):
    values = ", ".join(f"({n})" for n in sizes)
    return f"""WITH {PS}, rk AS (SELECT target_id, label_role, row_number() OVER (PARTITION BY target_id ORDER BY l2 DESC, candidate_index) AS rk FROM ps)
SELECT target_id, p AS n_positive, top, hits, {r("hits::DOUBLE / p", 6)} AS recall
FROM (SELECT target_id, top, count(*) FILTER (label_role = 'heldout_positive') AS p, count(*) FILTER (label_role = 'heldout_positive' AND rk <= top) AS hits
      FROM rk, (VALUES {values}) v(top) GROUP BY ALL)"""


@query("recall_fixed_k", within_sql((10, 20, 30)))
def recall_fixed_k(spark, sf):
    return ranking.hits_within(pair_scores(spark, sf), "l2", (10, 20, 30))


@query("topn_windows", within_sql((250, 500, 1000, 2000, 5000)))
def topn_windows(spark, sf):
    return ranking.hits_within(pair_scores(spark, sf), "l2", (250, 500, 1000, 2000, 5000))


EF = f"""
SELECT target_id, fraction, CASE WHEN max(positives) > 0 THEN {r("sum(share) / max(k) / (max(positives)::DOUBLE / max(total))", 4)} ELSE 0.0 END AS enrichment
FROM (SELECT *, CASE WHEN before + n <= k THEN p::DOUBLE WHEN before < k THEN (k - before) * p::DOUBLE / n ELSE 0 END AS share
      FROM (SELECT g.*, fraction, greatest(1, CAST(floor(total * fraction) AS BIGINT)) AS k FROM g, (VALUES (0.01::DOUBLE), (0.05::DOUBLE), (0.1::DOUBLE)) v(fraction)))
GROUP BY target_id, fraction"""


@query("enrichment_tied", f"WITH {PS}, {GROUPS.format(score='l2', where='')} {EF}")
def enrichment_tied(spark, sf):
    return ranking.enrichment_tied(pair_scores(spark, sf), "l2", (0.01, 0.05, 0.1))


BEDROC = f"""
SELECT target_id, CASE WHEN p = 0 THEN 0.0 WHEN hi = lo THEN 1.0 ELSE {r("greatest(0.0, least(1.0, (rie - lo) / (hi - lo)))", 4)} END AS bedroc
FROM (SELECT *, s / (p * (1 - exp(-20.0)) / (n * (exp(20.0 / n) - 1))) AS rie, (1 - exp(-20.0 * p / n)) / ((p / n) * (1 - exp(-20.0))) AS hi,
             (1 - exp(20.0 * p / n)) / ((p / n) * (1 - exp(20.0))) AS lo
      FROM (SELECT target_id, max(total)::DOUBLE AS n, max(positives)::DOUBLE AS p,
                   sum(g.p::DOUBLE / n * pow(exp(-20.0 / total), before + 1) * (1 - pow(exp(-20.0 / total), n)) / (1 - exp(-20.0 / total))) AS s
            FROM g GROUP BY target_id))"""


@query("bedroc_tied", f"WITH {PS}, {GROUPS.format(score='l2', where='')} {BEDROC}")
def bedroc_tied(spark, sf):
    return ranking.bedroc_tied(pair_scores(spark, sf), "l2")


@query(
    "bedroc_legacy",
    f"""WITH {PS}
SELECT target_id, {r("least(1.0, s / ((1 - exp(-20.0 * p / n)) / (1 - exp(-20.0))))", 6)} AS bedroc_upper
FROM (SELECT target_id, sum(exp(-20.0 * rk / n)) AS s, count(*) AS p, max(n)::DOUBLE AS n
      FROM (SELECT *, count(*) OVER (PARTITION BY target_id) AS n, row_number() OVER (PARTITION BY target_id ORDER BY l2 DESC, candidate_index) AS rk FROM ps)
      WHERE label_role = 'heldout_positive' GROUP BY target_id)""",
)
def bedroc_legacy(spark, sf):
    return ranking.bedroc_upper(pair_scores(spark, sf), "l2")


@query(
    "benchmark_labels",
    f"""WITH {PS}, {GROUPS.format(score='l2', where=LABELED)}
SELECT t.target_id, CASE WHEN a.auc IS NULL THEN 'not_evaluated' ELSE 'evaluated' END AS status, CASE WHEN a.auc IS NULL THEN 'positive and negative scores are both required' END AS reason,
       t.total, t.positive, t.negative, a.auc AS roc_auc, e1.enrichment AS ef_1pct, e5.enrichment AS ef_5pct, e2.enrichment AS ef_10pct, b.bedroc
FROM (SELECT target_id, count(*) AS total, count(*) FILTER (label_role = 'heldout_positive') AS positive, count(*) FILTER (label_role = 'heldout_negative') AS negative FROM ps GROUP BY 1) t
LEFT JOIN ({auc_sql("l2", LABELED, 4)}) a USING (target_id)
LEFT JOIN ({EF}) e1 ON e1.target_id = t.target_id AND e1.fraction = 0.01::DOUBLE AND a.auc IS NOT NULL
LEFT JOIN ({EF}) e5 ON e5.target_id = t.target_id AND e5.fraction = 0.05::DOUBLE AND a.auc IS NOT NULL
LEFT JOIN ({EF}) e2 ON e2.target_id = t.target_id AND e2.fraction = 0.1::DOUBLE AND a.auc IS NOT NULL
LEFT JOIN ({BEDROC}) b ON b.target_id = t.target_id AND a.auc IS NOT NULL""",
)
def benchmark_labels(spark, sf):
    """Metrics against explicit labels; not evaluated, with the reason, unless both classes have scores."""
    rows = pair_scores(spark, sf)
    labeled = rows.filter(F.col("label_role") != ranking.BACKGROUND)
    share = {"ef_1pct": 0.01, "ef_5pct": 0.05, "ef_10pct": 0.1}
    ef = ranking.enrichment_tied(labeled, "l2", list(share.values()))
    wide = ef.groupBy("target_id").agg(*[F.max(F.when(F.col("fraction") == f, F.col("enrichment"))).alias(c) for c, f in share.items()])
    wide = wide.join(rows.groupBy("target_id").agg(F.count("*").alias("total"), F.count_if(ranking.is_positive()).alias("positive"), F.count_if(F.col("label_role") == ranking.NEGATIVE).alias("negative")), "target_id", "right")
    out = ranking.auc(rows, "l2", digits=4, name="roc_auc").join(wide, "target_id", "left").join(ranking.bedroc_tied(labeled, "l2"), "target_id", "left")
    done = F.col("roc_auc").isNotNull()
    return out.select("target_id", F.when(done, "evaluated").otherwise("not_evaluated").alias("status"), F.when(~done, "positive and negative scores are both required").alias("reason"), "total", "positive", "negative", "roc_auc", *[F.when(done, F.col(c)).alias(c) for c in (*share, "bedroc")])


SA = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.95::DOUBLE - (greatest(0, rings - 3) * 0.15::DOUBLE + greatest(0, aromatic - 2) * 0.10::DOUBLE + greatest(0, rotatable - 6) * 0.08::DOUBLE + greatest(0, hetero - 6) * 0.06::DOUBLE + halogen * 0.05::DOUBLE + greatest(0, heavy - 35) * 0.02::DOUBLE)))"
VIO = "(CAST(mw > 500 AS INT) + CAST(logp > 5 AS INT) + CAST(hbd > 5 AS INT) + CAST(hba > 10 AS INT))"
SEV = "(severe + CASE WHEN cyanide AND (mw < 100 OR alkali) THEN 1 ELSE 0 END)"
CL = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, {}))"
HERG = CL.format("0.15::DOUBLE * CAST(mw > 350 AS INT) + 0.1::DOUBLE * CAST(mw > 500 AS INT) + 0.15::DOUBLE * CAST(logp > 3 AS INT) + 0.1::DOUBLE * CAST(logp > 5 AS INT) + 0.15::DOUBLE * CAST(aromatic >= 2 AS INT) + 0.1::DOUBLE * CAST(rotatable > 5 AS INT)")
ORAL = CL.format(f"1.0::DOUBLE - {VIO} * 0.15::DOUBLE - 0.1::DOUBLE * CAST(rotatable > 10 AS INT) - 0.15::DOUBLE * CAST(tpsa > 140 AS INT)")


@query(
    "l1_quality",
    f"""WITH {DE}, x AS (SELECT *, {r("mw", 2)} AS w, {r("logp", 3)} AS lp, {r("tpsa", 2)} AS tp FROM de)
SELECT part_key, {VIO} AS violations, {r(SA, 4)} AS sa,
  {r(CL.format(f'''0.0::DOUBLE + {r("qed", 4)} * 0.20::DOUBLE + {r(SA, 4)} * 0.15::DOUBLE + {CL.format(f"1.0::DOUBLE - {VIO} / 4.0::DOUBLE")} * 0.15::DOUBLE
  + (CASE WHEN w < 50 THEN 0.1::DOUBLE WHEN w < 150 THEN 0.5::DOUBLE + 0.5::DOUBLE * (w - 50) / 100 WHEN w <= 600 THEN 1.0::DOUBLE WHEN w <= 800 THEN 1.0::DOUBLE - (w - 600) / 200 * 0.4::DOUBLE ELSE 0.2::DOUBLE END) * 0.12::DOUBLE
  + (CASE WHEN lp < -2 THEN 0.3::DOUBLE WHEN lp < -0.5 THEN 0.5::DOUBLE + 0.5::DOUBLE * (lp + 2) / 1.5::DOUBLE WHEN lp <= 4 THEN 1.0::DOUBLE WHEN lp <= 6 THEN 1.0::DOUBLE - (lp - 4) / 2 * 0.4::DOUBLE ELSE 0.3::DOUBLE END) * 0.12::DOUBLE
  + (CASE WHEN tp < 20 THEN 0.4::DOUBLE WHEN tp <= 140 THEN 1.0::DOUBLE WHEN tp <= 200 THEN 1.0::DOUBLE - (tp - 140) / 60 * 0.5::DOUBLE ELSE 0.3::DOUBLE END) * 0.10::DOUBLE
  + {CL.format("1.0::DOUBLE - greatest(0, hbd - 4) / 5.0::DOUBLE")} * 0.08::DOUBLE
  + (CASE WHEN hba < 1 THEN 0.3::DOUBLE WHEN hba <= 10 THEN 1.0::DOUBLE ELSE {CL.format("1.0::DOUBLE - (hba - 10) / 6.0::DOUBLE")} END) * 0.08::DOUBLE'''), 4)} AS l1
FROM x""",
)
def l1_quality(spark, sf):
    return descriptors(spark, sf).select("part_key", layers.violations().alias("violations"), scalar.rounded(layers.synthesis(), 4).alias("sa"), layers.quality().alias("l1"))


@query(
    "l3_composite",
    f"""WITH {DE}, x AS (SELECT *, coalesce(tox21, 0.5) AS t, coalesce(clintox, 0.5) AS k, coalesce(sider, 0) AS s,
  greatest(0.0::DOUBLE, least(0.85::DOUBLE, {SEV} * 0.30::DOUBLE + moderate * 0.22::DOUBLE)) AS pen, {SEV} AS sev, {HERG} AS herg, {ORAL} AS oral,
  0.16::DOUBLE - 0.63::DOUBLE * logp - 0.0062::DOUBLE * mw + 0.066::DOUBLE * tpsa / 100 AS sol FROM de)
SELECT part_key, {r("herg", 4)} AS herg, {r("oral", 4)} AS oral, {r("sol", 2)} AS solubility, cyanide AND (mw < 100 OR alkali) AS acute,
  {r(CL.format("0.2::DOUBLE * CAST(mw > 400 AS INT) + 0.2::DOUBLE * CAST(logp > 3 AS INT) + 0.2::DOUBLE * CAST(aromatic >= 3 AS INT) + 0.1::DOUBLE * CAST(hba > 5 AS INT)"), 4)} AS cyp3a4,
  {r(CL.format("0.2::DOUBLE * CAST(logp > 2.5 AS INT) + 0.2::DOUBLE * CAST(aromatic >= 2 AS INT) + 0.1::DOUBLE * CAST(aliphatic > 0 AS INT)"), 4)} AS cyp2d6,
  coalesce(nullif(concat_ws(' | ', CASE WHEN heavy_metal THEN 'HEAVY_METAL' END, CASE WHEN sev > 0 THEN 'SEVERE' END, CASE WHEN moderate > 0 THEN 'MODERATE' END, CASE WHEN clintox > 0.5 THEN 'CLINTOX' END), ''), 'low') AS flags,
  {r(f'''least({CL.format(f"(1.0::DOUBLE - (pen * 0.50::DOUBLE + t * 0.20::DOUBLE + k * 0.15::DOUBLE + s * 0.15::DOUBLE)) * 0.40::DOUBLE + {CL.format('1.0::DOUBLE - (k * 0.4::DOUBLE + s * 0.3::DOUBLE + herg * 0.3::DOUBLE)')} * 0.25::DOUBLE + oral * 0.15::DOUBLE + {CL.format('(sol + 6) / 7')} * 0.10::DOUBLE + (CASE WHEN bbb < 0.5 THEN 1.0::DOUBLE - bbb ELSE 0.3::DOUBLE END) * 0.10::DOUBLE")},
    CASE WHEN heavy_metal OR sev >= 2 THEN 0.25::DOUBLE WHEN sev >= 1 THEN 0.35::DOUBLE WHEN moderate >= 2 THEN 0.50::DOUBLE ELSE 1.0::DOUBLE END)''', 4)} AS l3
FROM x""",
)
def l3_composite(spark, sf):
    d = descriptors(spark, sf)
    flags = layers.flag_text([F.when(F.col("heavy_metal"), "HEAVY_METAL"), F.when(layers.severe_alerts() > 0, "SEVERE"), F.when(F.col("moderate") > 0, "MODERATE"), F.when(F.col("clintox") > 0.5, "CLINTOX")])
    four = lambda x: scalar.rounded(x, 4)
    return d.select(
        "part_key", four(layers.herg()).alias("herg"), four(layers.oral()).alias("oral"), scalar.rounded(layers.solubility(), 2).alias("solubility"), layers.inorganic_cyanide().alias("acute"),
        four(layers.cyp3a4()).alias("cyp3a4"), four(layers.cyp2d6()).alias("cyp2d6"), flags.alias("flags"), layers.composite().alias("l3"),
    )


@query(
    "quality_gate_reasons",
    f"""WITH {PS}, {DE}, x AS (
  SELECT target_id, candidate_index, list_filter([CASE WHEN l2 < 0.2::DOUBLE THEN 'weak_binding' END, CASE WHEN l3 < 0.5::DOUBLE THEN 'low_admet' END, CASE WHEN {SEV} + moderate >= 2 THEN 'many_alerts' END,
    CASE WHEN {SEV} >= 1 THEN 'severe_alert' END, CASE WHEN {ORAL} < 0.4::DOUBLE THEN 'low_oral' END, CASE WHEN {HERG} > 0.6::DOUBLE THEN 'herg_risk' END], lambda z: z IS NOT NULL) AS reasons
  FROM ps JOIN de USING (part_key))
SELECT target_id, candidate_index, len(reasons) AS n_reasons, CASE WHEN len(reasons) < 2 THEN 'PASS' ELSE 'FAIL' END AS gate_status,
       CASE WHEN len(reasons) < 2 THEN '' ELSE array_to_string(reasons, '; ') END AS gate_reason
FROM x""",
)
def quality_gate_reasons(spark, sf):
    evidence = descriptors(spark, sf).select("part_key", (layers.severe_alerts() + F.col("moderate")).alias("alerts"), layers.severe_alerts().alias("severe"), layers.oral().alias("oral"), layers.herg().alias("herg"))
    rows = pair_scores(spark, sf).withColumn("admet", F.col("l3")).join(evidence, "part_key").withColumn("_reasons", layers.gate_reasons())
    status, reason = layers.gate(F.col("_reasons"))
    return rows.select("target_id", "candidate_index", F.size("_reasons").alias("n_reasons"), status.alias("gate_status"), reason.alias("gate_reason"))
