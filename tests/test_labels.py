import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions import scalar
from quillon.operators import audit, labels, routing, similarity


def pairs(spark, rows):
    return spark.createDataFrame(rows, "target_id string, key string, label int, o long")


def test_clean_pairs(spark):
    df = pairs(spark, [("t", "a", 1, 3), ("t", "a", 1, 1), ("t", "b", 1, 2), ("t", "b", 0, 4), ("u", "b", 0, 5), ("u", "c", None, 6)])
    assert sorted((r["target_id"], r["key"], r["label"], r["o"]) for r in labels.clean_pairs(df, ["target_id", "key"], ["o"]).collect()) == [("t", "a", 1, 1), ("u", "b", 0, 5)]


def test_splits_are_repeatable_and_disjoint(spark):
    df = pairs(spark, [("t", f"k{i % 40}", i % 2, i) for i in range(200)])
    a = labels.stratified_split(df.repartition(7), ["target_id", "key", "o"])
    b = labels.stratified_split(df.repartition(3), ["target_id", "key", "o"])
    assert sorted(map(tuple, a.select("o", "split").collect())) == sorted(map(tuple, b.select("o", "split").collect()))
    n = {(r["label"], r["split"]): r["n"] for r in a.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    assert n == {(0, "fit"): 80, (0, "heldout"): 20, (1, "fit"): 80, (1, "heldout"): 20}
    sides = labels.key_split(df, "key").groupBy("key").agg(F.countDistinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0


@pytest.mark.parametrize("size", [8, 11])
def test_pools_are_exact_unique_and_clean(spark, size):
    library = spark.createDataFrame([(f"m{i}",) for i in range(14)], "key string")
    held = pairs(spark, [("t", "m0", 1, 0), ("t", "m1", 0, 0), ("u", "x9", 1, 0)])
    fit = pairs(spark, [("t", "m2", 1, 0), ("t", "m3", 0, 0), ("u", "m0", 1, 0)])
    one, two = (sorted(map(tuple, labels.candidate_pools(held.repartition(n), library.repartition(n), fit, size).select("target_id", "key", "label_role", "candidate_index").collect())) for n in (1, 4))
    assert one == two
    for t in ("t", "u"):
        keys = [k for x, k, *_ in one if x == t]
        assert len(keys) == len(set(keys)) == size
        assert sorted(i for x, _, _, i in one if x == t) == list(range(size))
    assert not {("t", "m2"), ("t", "m3"), ("u", "m0")} & {(x, k) for x, k, *_ in one}


def test_target_order_and_fallback(spark):
    rows = [("a", 5, 5), ("b", 2, 5), ("c", 1, 0), ("d", 0, 3)]
    data = [(t, f"p{i}", 1, 0) for t, p, _ in rows for i in range(p)] + [(t, f"n{i}", 0, 0) for t, _, n in rows for i in range(n)]
    counts = labels.target_counts(pairs(spark, data))
    got = labels.select_targets(counts, spark.createDataFrame([("z", 0), ("y", 1), ("a", 2)], "target_id string, position int"), 5).orderBy("target_index").collect()
    assert [(r["target_id"], r["tier"]) for r in got] == [("a", "strict_labeled"), ("b", "limited_positive"), ("c", "limited_positive"), ("z", "unlabeled_fallback"), ("y", "unlabeled_fallback")]


def test_similarity(spark):
    sets = [(1, [1, 2, 3, 4]), (2, [1, 2, 3, 5]), (3, [9]), (4, []), (5, [1, 2, 3, 4])]
    df = spark.createDataFrame(sets, "id long, bits array<int>")
    want = {(a, b, round(len(set(x) & set(y)) / len(set(x) | set(y)), 6)) for a, x in sets for b, y in sets if a < b and set(x) & set(y)}
    for least in (0.3, 0.6, 1.0):
        got = {tuple(r) for r in similarity.tanimoto_pairs(df, df, least, same=True).collect()}
        assert got == {w for w in want if w[2] >= least}
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "id long, vector array<double>")
    refs = spark.createDataFrame([(7, [1.0, 1.0]), (8, [2.0, 0.0])], "id long, vector array<double>")
    got = {r["id"]: (r["score"], r["top"]) for r in similarity.nearest_references(v, refs, k=2).collect()}
    assert got[1] == (0.8536, [8, 7]) and got[2][0] == 0.0


def test_any_number_of_references(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-3, 4, (10_500, 3)).astype(float)  # many equal vectors
    refs = spark.createDataFrame([*((i, x.tolist()) for i, x in enumerate(base)), (-1, None), (-2, [float("nan")] * 3)], "id long, vector array<double>").repartition(7)
    asked = [(1, [1.0, 2.0, -1.0]), (1, [1.0, 2.0, -1.0]), (1, [0.5, -1.0, 3.0]), (None, [0.0, 1.0, 0.0]), (2, [0.0, 0.0, 0.0]), (3, None)]
    rows = spark.createDataFrame(asked, "id long, vector array<double>")
    unit = lambda x: [c / (math.sqrt(sum(y * y for y in x)) + 1e-8) for c in x]
    units = [unit(x) for x in base.tolist()]
    want = []
    for i, x in asked:
        best = sorted((-sum(a * b for a, b in zip(unit(x), u)), k) for k, u in enumerate(units))[:10] if x else []
        want.append((i, round(-sum(s for s, _ in best) / 10, 4) + 0.0 if x else None, [k for _, k in best[:5]]))
    got = [(r["id"], r["score"], r["top"]) for r in similarity.nearest_references(rows, refs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    none = similarity.nearest_references(rows, refs.limit(0)).collect()
    assert len(none) == 6 and {(r["score"], tuple(r["top"])) for r in none} == {(0.0, ()), (None, ())}


def test_routing(spark):
    reg = spark.createDataFrame([("T1", "Neur A", True, [1.0, 2.0, 3.0], [1.0, 1.0, 1.0]), ("T2", "Other", True, [1.0, 2.0, 3.0], [0.0, 1.0, 1.0]), ("T3", "gone", False, [1.0] * 3, [1.0] * 3)], "reg_key string, reg_name string, available boolean, box_center array<double>, box_size array<double>")
    t = spark.createDataFrame([("T1", "x"), ("q", " neur_A "), ("T2", "x"), ("T3", "x"), ("w", None)], "target_id string, target_name string")
    found = routing.lookup_receptors(t, reg)
    got = {r["target_id"]: (r["branch"], r["reason"]) for r in routing.route(found).collect()}
    assert got == {"T1": ("cascade", "receptor"), "q": ("cascade", "receptor"), "T2": ("library", "invalid_box"), "T3": ("library", "file_missing"), "w": ("library", "not_registered")}
    with pytest.raises(Exception, match="no valid receptor"):
        routing.route(found, mode="cascade").collect()


def test_audits_see_tampering(spark):
    a = spark.createDataFrame([(1, "x", 0.5), (2, "y", 0.6), (3, None, 0.7)], "id long, s string, v double")
    b = spark.createDataFrame([(2, "z", 0.6), (3, None, 0.75), (4, "w", 0.1)], "id long, s string, v double")
    assert sorted(map(tuple, audit.identity(a, b, "id", "s").collect())) == [(1, "missing"), (2, "changed"), (4, "unexpected")]
    assert {r["column"]: r["changed"] for r in audit.changed_columns(a, b, ["id"], ["s", "v"]).collect()} == {"s": 1, "v": 1}
    assert audit.digest(a, ["id", "s"]).first()["digest"] == audit.digest(a.orderBy(F.col("id").desc()).repartition(3), ["id", "s"]).first()["digest"]
    assert audit.digest(a, ["id", "v"]).first()["digest"] != audit.digest(b, ["id", "v"]).first()["digest"]
    m = spark.createDataFrame([("a", "0" * 64), ("b", "1" * 64), ("c", "short"), ("d", "2" * 64)], "path string, digest string")
    f = spark.createDataFrame([("a", "0" * 64), ("b", "3" * 64), ("c", "4" * 64), ("e", "5" * 64)], "path string, digest string")
    assert sorted(map(tuple, audit.compare_files(m, f).collect())) == [("b", "mismatch"), ("c", "malformed"), ("d", "missing"), ("e", "unexpected")]


def test_parsing(spark):
    df = spark.createDataFrame([(x,) for x in ("1", " 0.0 ", "2", "nan", "inf", "", "x", None, "1.5")], "t string")
    got = [(r[0], r[1]) for r in df.select(scalar.number(F.col("t")), scalar.label(F.trim("t"))).collect()]
    assert got == [(1.0, 1), (0.0, 0), (2.0, None), (None, None), (None, None), (None, None), (None, None), (None, None), (1.5, 1)]
    df = spark.createDataFrame([("P1 CHEMBL12 1abc Kinase x",)], "t string")
    assert tuple(df.select(scalar.target_code(F.col("t")), scalar.trailing_name(F.col("t"))).first()) == ("CHEMBL12", "Kinase x")
