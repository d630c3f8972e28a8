"""Steps whose cost must not grow faster than the rows of a group."""

from quillon.operators import models, ranking

P, N = ranking.POSITIVE, ranking.NEGATIVE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().lower()


def test_auc_has_no_frame_that_is_summed_anew_for_each_row(spark):
    df = spark.createDataFrame([("t", i, P if i % 3 else N, float(i % 7)) for i in range(60)], "target_id string, candidate_index long, label_role string, score double")
    out = ranking.auc(df, "score")
    assert ", 1, unboundedfollowing" not in plan(out)
    rows = [(i % 7, i % 3 > 0) for i in range(60)]
    wins = sum((a > b) + (a == b) / 2 for a, p in rows if p for b, q in rows if not q)
    assert out.first()["auc"] == round(wins / 800, 6)


def test_training_rows_are_dealt_to_all_cores(spark):
    one_split = spark.range(100).coalesce(1)
    assert models.dealt(one_split).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_shuffles_widen_with_the_rows_of_a_table(spark, sf, monkeypatch):
    from quillon.functions import session
    from quillon.plans import views

    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {n: spark.conf.get(n) for n in names}
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    try:
        rows = views.table(spark, sf, "lineitem").count()
        assert int(spark.conf.get(names[0])) >= rows / 500 > int(before[names[0]])
        assert spark.conf.get(names[1]) == str(session.TASK_BYTES)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_blocks_of_targets_grow_with_their_number(spark, monkeypatch):
    sizes, sided = [], models._sided
    monkeypatch.setattr(models, "TARGETS", 2)
    monkeypatch.setattr(models, "TARGET_BLOCKS", 4)
    monkeypatch.setattr(models, "_sided", lambda df, key, w, b, size, name: sizes.append((key, size)) or sided(df, key, w, b, size, name))
    rows = lambda name, n: spark.createDataFrame([(i, [float(i % 5), 1.0]) for i in range(n)], f"{name} long, features array<double>")
    out = models.pair_grid_top(rows("mol_id", 30), rows("target_id", 40), models.rule_towers(2, 2, (8, 4)), k=3)
    assert out.count() == 120 and ("target_id", 10) in sizes


def test_texts_are_not_shuffled_with_their_tokens(spark, monkeypatch):
    saved, plans = models.saved, []
    monkeypatch.setattr(models, "saved", lambda df, name: plans.append(plan(df)) or saved(df, name))
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, "a b a"), (4, None)], "id int, text string")
    assert models.signed_text_features(df, "text", 8).count() == 4
    assert len(plans) == 1 and "unhex(sha2(" in plans[0] and "hashpartitioning(_whole" not in plans[0]
