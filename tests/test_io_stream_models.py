import gzip
import json
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from quillon.functions import layers
from quillon.operators import audit, labels, models
from quillon.plans import q_models
from quillon.sources import readers, writers
from quillon.streaming import jobs, state


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_candidate_contract(spark, tmp_path):
    good = put(tmp_path / "a.csv", "﻿id,smiles,note\n m1 , CC ,x\nm2,CO,y\n")
    assert [tuple(r) for r in readers.candidates(spark, good)[0].orderBy("id").collect()] == [("m1", "CC"), ("m2", "CO")]
    bad = put(tmp_path / "b.csv", "id,smiles\nm1,CC\nm1,CO\nm2,\nm3,C\n")
    with pytest.raises(ValueError, match="duplicate id 'm1'"):
        readers.candidates(spark, bad)
    rows, problems = readers.candidates(spark, bad, strict=False)
    assert [r["id"] for r in rows.collect()] == ["m3"] and problems.count() == 2
    with pytest.raises(ValueError, match="missing columns: smiles"):
        readers.candidates(spark, put(tmp_path / "c.csv", "id\n1\n"))
    s = readers.candidate_summary(rows, declared=2).first()
    assert (s["n_rows"], s["error"]) == (1, "expectedCandidateCount:mismatch")


def test_text_sources(spark, tmp_path):
    tsv = put(tmp_path / "m.tsv", "# head\n\nA\tt1\tname\nB\tt2\nA\tt9\tlate\n")
    assert {r["acc"]: r["target"] for r in readers.keyed_lines(spark, tsv, ["acc", "target", "name"]).collect()} == {"A": "t1", "B": "t2"}
    lines = put(tmp_path / "l.txt", "CC\n\nCO\nCC\nCN\n")
    assert {(r["s"], r["library_index"]) for r in readers.library(spark, lines, "s").collect()} == {("CC", 0), ("CO", 2), ("CN", 4)}
    with pytest.raises(ValueError):
        readers.library(spark, lines, "s", least=9)
    with gzip.open(tmp_path / "d.tsv.gz", "wt") as f:
        f.write("1\tCC\n2\tCO\n3\tCX\n")
    got = readers.tsv_column(spark, str(tmp_path / "d.tsv.gz"), 1, exclude=spark.createDataFrame([("CC",)], "x string"))
    assert {r["value"] for r in got.collect()} == {"CO", "CX"}
    fa = put(tmp_path / "s.fa", ">sp|x [P1] name\nMKV\nLL\n>P2 other\nAAA\n")
    assert {tuple(r) for r in readers.fasta(spark, fa).collect()} == {("P1", "MKVLL"), ("P2", "AAA")}
    reg = put(tmp_path / "r.json", json.dumps({"entries": {"T": {"target_name": "n", "pdbqt": "f", "box_center": [1, 2, 3], "box_size": [4, 5, 6]}}}))
    assert readers.registry(spark, reg).first()["box_size"] == [4.0, 5.0, 6.0]
    assert readers.registry(spark, str(tmp_path / "none.json")).count() == 0
    refs = put(tmp_path / "refs.csv", "# x\nCC,a\nCO\n")
    assert readers.reference_list(spark, refs, [("d", "C")]).collect()[0]["name"] == "d"
    assert {r["name"] for r in readers.reference_list(spark, refs, [("d", "C")], least=2).collect()} == {"a", "CO"}
    lp = put(tmp_path / "p.csv", "source_smiles,target_text,label\nCC,t,1\nCC,t,0.0\n,t,1\nCO,t,7\n")
    assert readers.labelled_pairs(spark, {"a": lp, "b": lp}).count() == 4


def test_base_scores(spark, tmp_path):
    want = spark.createDataFrame([("1", "CC"), ("2", "CO")], "id string, smiles string")
    ok = put(tmp_path / "ok.csv", "id,smiles,final_score\n1,CC,0.1\n2,CO,0.2\n")
    assert readers.base_scores(spark, ok, want, required=["final_score"]).count() == 2
    with pytest.raises(ValueError, match="changed id '2'"):
        readers.base_scores(spark, put(tmp_path / "x.csv", "id,smiles,final_score\n1,CC,0.1\n2,CX,0.2\n"), want, required=["final_score"])


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(t, i, (t * i) % 7 / 7) for t in (1, 2, 3) for i in range(30)], "target_id int, candidate_index long, final_score double")
    path = str(tmp_path / "scores")
    writers.scores_by_target(df, path)
    writers.scores_by_target(df.filter("target_id = 2").withColumn("final_score", F.lit(9.0)), path)
    back = readers.partitioned_scores(spark, path)
    assert back.count() == 90 and back.filter("final_score = 9").select("target_id").distinct().collect()[0][0] == 2
    writers.top_hits(df, str(tmp_path / "hits"), n=5)
    assert all(len(r["hits"]) == 5 for r in spark.read.json(str(tmp_path / "hits")).collect())
    writers.table(df, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="repeated keys"):
        readers.cache(spark, str(tmp_path / "t"), "candidate_index")
    writers.append_events(df.limit(3), str(tmp_path / "ev"))
    writers.append_events(df.limit(2), str(tmp_path / "ev"))
    assert spark.read.json(str(tmp_path / "ev")).count() == 5
    writers.summary(df.limit(1), str(tmp_path / "sum"))
    assert len(spark.read.json(str(tmp_path / "sum")).first()["digest"]) == 64
    ranked = df.withColumn("dock_rank", F.when(F.col("candidate_index") < 3, F.col("candidate_index")))
    writers.reranked(ranked, str(tmp_path / "rr"))
    assert spark.read.option("header", True).csv(str(tmp_path / "rr")).count() == 9
    digests = readers.file_digests(spark, str(tmp_path / "t"), pattern="*.parquet")
    assert all(len(r["digest"]) == 64 for r in digests.collect())


def test_stream_equals_batch(spark, sf, tmp_path):
    events = q_models.stage_events(spark, sf)
    folder = str(tmp_path / "in")
    events.repartition(4).write.parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    state.keep_state(state.track(stream, delay="60 days"), str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    key = lambda df: sorted(map(tuple, df.select("run", "stage", "status", "attempts", "n_events").collect()))
    assert key(state.state_now(spark, str(tmp_path / "state"))) == key(jobs.stage_state(events))


def test_streamed_scores(spark, tmp_path):
    rows = [(i % 40, i % 5, i % 7 / 7, 0.5, 0.25, None if i % 9 == 0 else 0.75) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, part_key long, l1 double, l2 double, l3 double, l4 double").withColumn("seen", F.current_timestamp())
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = jobs.stream_scores(spark, str(tmp_path / "in"), df.schema, key="id", seen="seen")
    jobs.run_to_table(out, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 40
    assert got.filter("l4 is null").filter("status = 'ok' or final_score is not null").count() == 0


def test_pair_grid_equals_plain_forward(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(models, "MOLECULES", 128)
    monkeypatch.setattr(models, "TARGETS", 2)
    monkeypatch.setattr(models, "NEAR", 16)
    mols, targets = rng.normal(size=(300, 6)), rng.normal(size=(5, 4))
    mols[200:] = mols[:100]  # ties
    m = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(mols)] + [(None, [1.0]), (900, None)], "mol_id long, features array<double>").repartition(3)
    t = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(targets)], "target_id long, features array<double>")
    for net in (models.towers(6, 4), models.rule_towers(6, 4, (12, 5))):
        got = models.pair_grid_top(m, t, net, k=7).collect()
        for j in range(5):
            plain = sorted(((-float(models.plain_forward(x, targets[j], net)[0]), i) for i, x in enumerate(mols)))[:7]
            mine = sorted((-r["score"], r["mol_id"], r["rank"]) for r in got if r["target_id"] == j)
            assert [i for _, i, _ in mine] == [i for _, i in plain] and [r for *_, r in mine] == list(range(1, 8))
            assert max(abs(a - b) for (a, *_), (b, _) in zip(mine, plain)) < 1e-9
    assert models.pair_grid_top(m.limit(0), t, net).count() == 0


def test_bounds_of_the_grid_hold_and_skip():
    rng = np.random.default_rng(4)
    net = models.towers(6, 4, (8, 4))
    centre = rng.normal(size=(20, 8)) * 3
    left = np.concatenate([c + rng.normal(size=(64, 8)) * 0.01 for c in centre])
    ids, part = rng.permutation(len(left)), rng.normal(size=8)
    plain = (np.maximum(np.maximum(left + part, 0) @ net["w2"] + net["b2"], 0) @ net["w3"] + net["b3"])[:, 0]
    assert (models._upper(left.min(axis=0) + part, left.max(axis=0) + part, net) >= plain.max() - 1e-9).all()
    got, scores, scored = models.best_of_block(left, ids, part, net, 10, -np.inf)
    want = np.lexsort((ids, -plain))[:10]
    assert got.tolist() == ids[want].tolist() and np.allclose(scores, plain[want]) and scored < len(left) / 2


def test_models_beat_chance(spark):
    sf = "/root/testdata/sf0.01"
    for name in ("train_logistic", "train_pairwise", "train_mlp", "train_forest"):
        assert all(r["auc"] > 0.75 for r in q_models.QUERIES[name](spark, sf).collect()), name


def test_text_pair_model_finds_a_planted_word(spark):
    docs = spark.createDataFrame([(i, ["s1", "s2"][i % 2], "some words here " + ("poison" if i % 3 == 0 else "flower")) for i in range(300)], "doc_id long, source string, text string")
    left = models.signed_text_features(docs.select("doc_id", "text"), "text", 520, "doc_vec").drop("text")
    right = models.signed_text_features(docs.select("source").distinct(), "source", 256, "source_vec")
    rows = docs.select("doc_id", "source", (F.col("doc_id") % 3 == 0).cast("int").alias("label"))
    pairs = models.assemble(rows, left, right, ["doc_id", "source"], ["doc_vec", "source_vec"])
    assert pairs.count() == 300 and len(pairs.first()["features"]) == 776
    fit = LogisticRegression(weightCol="weight", regParam=0.01, maxIter=30).fit(models.balanced(pairs.filter("doc_id % 5 > 0")))
    assert models.predict(fit, pairs.filter("doc_id % 5 = 0")).filter("(p > 0.5) <> (label = 1)").count() == 0


def test_pairwise_training_uses_every_row(spark, monkeypatch):
    given = []
    train = models.train_pairwise
    monkeypatch.setattr(models, "train_pairwise", lambda better, worse, by, columns: given.append((better, worse)) or train(better, worse, by, columns))
    sf = "/root/testdata/sf0.001"
    q_models.train_pairwise(spark, sf)
    fit = q_models.labelled(spark, sf).filter("not held")
    assert [x.count() for x in given[0]] == [fit.filter(f"label = {k}").count() for k in (1, 0)]
    better = [("a", float(i)) for i in range(1000)] + [("b", 1.0), ("b", 1.0), ("c", 5.0)]
    worse = [("a", float(-i)) for i in range(1, 8)] + [("b", float(-i)) for i in range(1, 40)] + [("d", 0.0)]
    frame = lambda rows: spark.createDataFrame(rows, "g string, x double").repartition(5)
    pairs = [tuple(r) for r in models.partners(frame(better), frame(worse), ["g"], ["x"]).collect()]
    assert sorted((g, x) for g, x, _ in pairs if g == "a") == better[:1000] and sorted((g, y) for g, _, y in pairs if g == "b") == sorted(worse[7:46])
    times = Counter(y for g, _, y in pairs if g == "a")
    assert set(times) == {y for g, y in worse if g == "a"} and max(times.values()) - min(times.values()) <= 1
    assert {g for g, *_ in pairs} == {"a", "b"}


def test_minhash_recall(spark):
    from quillon.operators import similarity
    from quillon.plans import q_audit

    sf = "/root/testdata/sf0.001"
    exact = {(r["id_a"], r["id_b"]) for r in q_audit.tanimoto_pairs(spark, sf).collect()}
    rows = q_audit.fingerprints(spark, sf).select("id", "bits")
    found = [(r["id_a"], r["id_b"]) for r in similarity.minhash_pairs(rows, 0.6).collect()]
    assert set(found) <= exact and len(found) == len(set(found)) and len(found) >= 0.9 * len(exact)
    # bands of more sets than a part has, equal sets, and sets without bits
    many = spark.createDataFrame([(i, [1, 2, 3, 4, 5, 6, 7, 8, 9, 10 + i % 20]) for i in range(120)] + [(500, []), (501, None)], "id long, bits array<int>")
    want = {(a, b) for a in range(120) for b in range(a + 1, 120)}
    for most in (7, 1000):
        got = [(r["id_a"], r["id_b"], r["similarity"]) for r in similarity.minhash_pairs(many, 0.6, most=most).collect()]
        assert len(got) == len({x[:2] for x in got}) and {x[:2] for x in got} <= want and len(got) >= 0.9 * len(want)
        assert all(s == (1.0 if (a - b) % 20 == 0 else round(9 / 11, 6)) for a, b, s in got)


def test_signed_hash(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, "a b a")], "id long, t string")
    v = {r["id"]: r["text_vec"].toArray() for r in models.signed_text_features(df, "t", 32).collect()}
    assert sum(abs(v[1])) in (1.0, 3.0) and sum(abs(v[2])) == 1.0
    assert (v[2] == v[3]).all() and (v[1] == v[4]).all()


def test_rules_that_raise(spark):
    rows = spark.createDataFrame([(1, 5), (2, 6)], "target_id long, part_key long")
    cache = spark.createDataFrame([(5, "x")], "part_key long, v string")
    with pytest.raises(ValueError, match="lacks keys such as 6"):
        audit.total_join(rows, cache, "part_key")
    assert audit.total_join(rows.filter("part_key = 5"), cache, "part_key").count() == 1
    counts = spark.createDataFrame([(1, 7, 6, "strict_labeled")], "target_id long, n_positive long, n_negative long, tier string")
    fallback = spark.createDataFrame([(9, 0), (8, 1), (9, 2)], "target_id long, position long")
    got = labels.select_targets(counts, fallback, 3).orderBy("target_index").collect()
    assert [r["target_id"] for r in got] == [1, 9, 8]
    with pytest.raises(ValueError, match="3 targets, expected 4"):
        labels.select_targets(counts, fallback, 4)


def test_evidence_and_report(spark, tmp_path):
    for name, cols in (("association", "drugId long, target_id long"), ("drug", "id long"), ("target", "targetId long")):
        spark.createDataFrame([(1, 2)[: cols.count(",") + 1]], cols).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = readers.evidence(spark, str(tmp_path), alternatives={"drug": ("drug_id", "drugId", "id"), "target": ("target_id", "targetId")})
    assert {n: d.columns for n, d in found.items()} == {"association": ["drug", "target"], "drug": ["drug"], "target": ["target"]}
    rows = writers.report(spark.createDataFrame([("auc", 3, 0.5)], "metric string, n long, median double"), spark.createDataFrame([("ok", 4)], "docking_status string, n long"))
    assert {tuple(r) for r in rows.collect()} == {("metric:auc", "n", 3.0), ("metric:auc", "median", 0.5), ("status", "ok", 4.0)}


def test_light_cyanide_is_a_severe_alert(spark):
    names = "mw logp tpsa hbd hba rotatable aromatic aliphatic severe moderate tox21 clintox sider bbb heavy_metal cyanide alkali".split()
    base = dict.fromkeys(names, 0.0) | {"mw": 27.0, "tox21": 0.0, "clintox": 0.0, "sider": 0.0, "bbb": 0.9, "heavy_metal": False, "cyanide": True, "alkali": False, "severe": 0, "moderate": 0}
    rows = [base, base | {"mw": 300.0}, base | {"mw": 300.0, "alkali": True}, base | {"severe": 1}]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} {'boolean' if n in ('heavy_metal', 'cyanide', 'alkali') else 'int' if n in ('severe', 'moderate') else 'double'}" for n in names))
    l3 = [r["l3"] for r in df.coalesce(1).select(layers.composite().alias("l3")).collect()]
    assert (l3[0], l3[2], l3[3]) == (0.35, 0.35, 0.25) and l3[1] > 0.5
