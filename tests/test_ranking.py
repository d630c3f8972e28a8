"""Ranking metrics on small frames with values worked out by hand."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quillon.functions import layers, scalar
from quillon.operators import fusion, ranking, stats

P, N, B = ranking.POSITIVE, ranking.NEGATIVE, ranking.BACKGROUND


def frame(spark, rows):
    return spark.createDataFrame([("t", i, r, None if s is None else float(s)) for i, (r, s) in enumerate(rows)], "target_id string, candidate_index long, label_role string, score double")


def one(df):
    return df.collect()[0]


def test_metric_frame(spark):
    rows = [(P, 1.0)] + [(P, 0.9 - i / 100) for i in range(4)] + [(N, 0.1 - i / 100) for i in range(5)] + [(B, 0.5)] * 90
    df = frame(spark, rows)
    assert one(ranking.auc(df, "score"))["auc"] == 1.0
    assert one(ranking.auc(df.withColumn("score", -F.col("score")), "score"))["auc"] == 0.0
    early = one(ranking.early_retrieval(df, "score", fraction=0.01))
    assert (early["top_k"], early["recall"], early["enrichment"]) == (1, 0.2, 20.0)


def test_auc_needs_both_classes(spark):
    df = frame(spark, [(P, 1.0)] * 5 + [(B, 0.5)] * 90)
    assert one(ranking.auc(df, "score"))["auc"] is None
    assert one(ranking.auc(df, "score", empty=0.0))["auc"] == 0.0
    assert one(ranking.auc(df, "score", negatives="all"))["auc"] == 1.0


def test_enrichment_shares_boundary_ties(spark):
    df = frame(spark, [(P, 8.0), (N, 8.0), (N, 5.0)])
    assert one(ranking.enrichment_tied(df, "score", [2 / 3]))["enrichment"] == 1.5


def reference_auc(rows):
    pos = [s for r, s in rows if r == P and s is not None and math.isfinite(s)]
    neg = [s for r, s in rows if r == N and s is not None and math.isfinite(s)]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def reference_bedroc(rows, alpha=20.0):
    ranked = sorted(((s, r == P) for r, s in rows if s is not None and math.isfinite(s)), key=lambda x: -x[0])
    n, p, total = len(ranked), sum(x for _, x in ranked), 0.0
    for s in {s for s, _ in ranked}:
        at = [i for i, (v, _) in enumerate(ranked, 1) if v == s]
        share = sum(ranked[i - 1][1] for i in at) / len(at)
        total += share * sum(math.exp(-alpha * i / n) for i in at)
    rie = total / (p * (1 - math.exp(-alpha)) / (n * (math.exp(alpha / n) - 1)))
    ratio = p / n
    hi = (1 - math.exp(-alpha * ratio)) / (ratio * (1 - math.exp(-alpha)))
    lo = (1 - math.exp(alpha * ratio)) / (ratio * (1 - math.exp(alpha)))
    return max(0.0, min(1.0, (rie - lo) / (hi - lo)))


@pytest.mark.parametrize("seed", range(3))
def test_tied_metrics_equal_plain_loops(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([P, N, B]), rng.choice([None, float("nan"), float("inf"), *[rng.randrange(6) / 4 for _ in range(9)]])) for _ in range(80)]
    df = frame(spark, rows)
    assert one(ranking.auc(df, "score"))["auc"] == pytest.approx(reference_auc(rows), abs=1e-6)
    assert one(ranking.bedroc_tied(df, "score"))["bedroc"] == pytest.approx(reference_bedroc(rows), abs=1e-4)


def test_missing_and_infinite_scores_come_last(spark):
    df = frame(spark, [(P, float("inf")), (P, None), (N, 0.1), (N, float("nan")), (N, 0.3)])
    got = [r["candidate_index"] for r in ranking.stable_rank(df, "score").orderBy("rank").collect()]
    assert got == [4, 2, 0, 1, 3]
    assert ranking.top_n(df, "score", 0).count() == 0


def test_selection_order(spark):
    df = frame(spark, [(B, 0.2), (B, 0.9), (B, 0.5), (B, 0.5)])
    assert [r["candidate_index"] for r in ranking.top_n(df, "score", 3).orderBy("rank").collect()] == [1, 2, 3]


def test_top_count_rounds_half_to_even(spark):
    df = spark.createDataFrame([(250,), (350,), (10,)], "n long")
    assert [r[0] for r in df.select(scalar.top_count(F.col("n"), 0.01)).collect()] == [2, 4, 1]


def test_overall_rank_and_page(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(12)], "pos long, s double")
    assert {(r["s"], r["rank"]) for r in ranking.overall_rank(df, "s").collect()} == {(3.0, 1), (2.0, 4), (1.0, 7), (0.0, 10)}
    rows = ranking.page(df, valid=F.col("s") > 0, score="s", position="pos", view="ranked", offset=2, limit=3).collect()
    assert [(r["pos"], r["total"]) for r in rows] == [(11, 9), (2, 9), (6, 9)]
    with pytest.raises(ValueError):
        ranking.page(df, valid=F.lit(True), score="s", position="pos", view="all", offset=0, limit=201)


def test_fusion_changes_successful_rows_only(spark):
    scores = spark.createDataFrame([("t", i, 0.1 * i) for i in range(6)], "target_id string, candidate_index long, l2 double")
    results = spark.createDataFrame([("t", 1, "ok", -8.0, 20), ("t", 2, "prep_failed", -9.0, 20), ("t", 4, "ok", -6.0, 30)], "target_id string, candidate_index long, status string, affinity double, heavy_atoms int")
    out = fusion.attach(scores, results).withColumn("fused", fusion.corrected("l2", "ligand_efficiency")).collect()
    by = {r["candidate_index"]: r for r in out}
    assert by[2]["docking_status"] == "prep_failed" and by[2]["ligand_efficiency"] is None and by[0]["docking_status"] == "not_selected"
    assert all(by[i]["fused"] == by[i]["l2"] for i in (0, 2, 3, 5))
    spread = (sum((0.1 * i - 0.25) ** 2 for i in range(6)) / 6) ** 0.5
    assert by[1]["fused"] == pytest.approx(0.1 + 0.3 * spread, abs=1e-6) and by[4]["fused"] == pytest.approx(0.4 - 0.3 * spread, abs=1e-6)


def test_combine_and_gate(spark):
    df = spark.createDataFrame([(1.0, 0.5, 0.2, 0.3), (0.12345, 0.12345, 0.12345, 0.12345)], "l1 double, l2 double, l3 double, l4 double")
    assert [r[0] for r in df.select(scalar.combine(scalar.FOUR_LAYER)).collect()] == [0.52, 0.1234]
    rows = [(0.1, 0.9, 0, 0, 0.9, 0.1), (0.1, 0.3, 0, 0, 0.9, 0.1), (0.9, 0.9, None, None, None, None)]
    df = spark.createDataFrame(rows, "l2 double, admet double, alerts int, severe int, oral double, herg double").withColumn("_r", layers.gate_reasons())
    status, reason = layers.gate(F.col("_r"))
    got = [tuple(r) for r in df.select(status, reason).collect()]
    assert got == [("PASS", ""), ("FAIL", "weak_binding; low_admet"), ("PASS", "")]


def test_rounding_is_half_to_even_on_the_double(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (0.375,)], "x double")
    assert [r[0] for r in df.select(scalar.rounded(F.col("x"), 2)).collect()] == [2.68 if round(267.5) == 268 and 2.675 * 100 == 267.5 else 2.67, 0.12, 0.38]


def test_summaries(spark):
    rows = [(i, 0.5 + 0.4 * i / 19) for i in range(20)]
    df = spark.createDataFrame(rows, "target_id long, auc double")
    long = stats.long_metrics(df, ["auc"])
    a, b = (sorted(map(tuple, stats.bootstrap_median(long, reps=50).collect())) for _ in range(2))
    assert a == b
    five = one(stats.five_numbers(long))
    assert five["n"] == 20 and five["median"] == pytest.approx(0.7, abs=1e-6)
    hist = {r["bin"]: r["n"] for r in stats.histogram(df, "auc").collect()}
    assert len(hist) == 20 and sum(hist.values()) == 20
