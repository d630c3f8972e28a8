"""What the findings of round 4 were about."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import jaccard
from quillon.operators import models, similarity
from quillon.plans import catalog
from quillon.sources import readers


def parts(folder, copies=3):
    """A table of parts in which each text occurs several times, and near copies of it."""
    names = "(CASE i % 5 WHEN 0 THEN 'red bolt large shiny' WHEN 1 THEN 'red bolt large round' ELSE 'blue ring of size ' || i % 40 END)"
    duckdb.sql(f"COPY (SELECT i AS p_partkey, {names} AS p_name, 'Brand#' || i % 2 AS p_brand, 'PROMO BURNISHED TIN' AS p_type, CAST(i % 4 AS INTEGER) AS p_size FROM range({40 * copies}) t(i)) TO '{folder}/part.parquet'")


@pytest.mark.parametrize("name", ["tanimoto_pairs", "minhash_join"])
def test_joins_give_all_pairs_of_rows(spark, tmp_path, monkeypatch, name):
    """Copies came with their first one only, in the query and in its SQL."""
    monkeypatch.setattr(similarity, "MEMBER_BLOCK", 4)
    parts(tmp_path)
    got = [(r["id_a"], r["id_b"], r["similarity"]) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    want = con.execute(catalog.ORACLES[name]).fetchall()
    assert sorted(got) == sorted(want)
    copies = {(a, b) for a in range(120) for b in range(a + 1, 120) if (b - a) % 40 == 0}
    assert copies < {x[:2] for x in got} and len(got) > 9 * len(copies)


def test_minhash_broadcasts_neither_bands_nor_sets(spark):
    """The planner took the bands for as few rows as the sets, and sent all of them through the driver."""
    rows = spark.range(300).select("id", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (F.col("id") * 11 + i * 17) % 2048).cast("array<int>").alias("bits"))
    plan = similarity.minhash_pairs(rows, 0.6)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") <= 1  # the keys of many sets
    assert similarity.minhash_pairs(rows, 0.6, most=5).count() == similarity.minhash_pairs(rows, 0.6).count()


def test_grid_scores_in_single_precision_and_keeps_exact_ranks(monkeypatch):
    """All molecules were scored in double precision, and their intervals anew for each target."""
    rng, net, rows = np.random.default_rng(5), models.rule_towers(6, 4, (32, 16)), []
    left = rng.normal(size=(700, 6)) @ net["left"]
    left[350:] = left[:350] * (1 + 1e-9 * rng.integers(0, 2, (350, 1)))  # ties, and differences that single precision can't tell
    ids, exact = rng.permutation(700), models.exact_scores
    monkeypatch.setattr(models, "exact_scores", lambda first, net: rows.append(len(first)) or exact(first, net))
    block = models.Block(left, net)
    for part in rng.normal(size=(30, 4)) @ net["right"]:
        scores = exact(left + part, net)
        assert np.abs(block.quick(part, None) + net["b3"][0] - scores).max() <= block.error(part, net)
        want = np.lexsort((ids, -scores))[:20]
        floor = float(scores[want[-1]])
        for least in (-np.inf, floor):
            got, found, _ = models.best_of_block(block, ids, part, net, 20, least)
            assert got.tolist() == ids[want].tolist() and found.tolist() == scores[want].tolist()
    assert sum(rows) < 0.5 * 700 * 60


def test_files_are_digested_piece_by_piece(spark, tmp_path):
    """A task held a whole file, and read it twice."""
    content = {"a.bin": b"y" * 9, "b c%20ä.bin": bytes(range(256)) * 5000, "sub/d.bin": b"x"}
    (tmp_path / "sub").mkdir()
    for name, raw in content.items():
        (tmp_path / name).write_bytes(raw)
    found = readers.file_digests(spark, str(tmp_path), pattern="*.bin")
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r["path"].split(tmp_path.name + "/")[1], r["digest"], r["length"]) for r in found.collect()}
    assert got == {(name, hashlib.sha256(raw).hexdigest(), len(raw)) for name, raw in content.items()}


def test_tokens_are_counted_where_texts_are_read(spark, monkeypatch):
    """A row for each bin of each text was shuffled, and texts were, too."""
    saved, plans = models.saved, []
    monkeypatch.setattr(models, "saved", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or saved(df, name))
    df = spark.createDataFrame([(i, " ".join(f"w{i * j % 41}" for j in range(i))) for i in range(60)] + [(60, None), (61, "w1\t w1")], "id long, t string")
    got = {r["id"]: r["v"].toArray().tolist() for r in models.signed_text_features(df, "t", 16, "v").collect()}
    assert len(plans) == 1 and "Generate" not in plans[0] and plans[0].count("Exchange") == 1
    h = F.xxhash64("w")
    sums = df.select("id", F.explode(F.split(F.when(F.length("t") > 0, F.col("t")).otherwise("<unknown>"), r"\s+")).alias("w")).groupBy("id", F.pmod(h, F.lit(16)).alias("b")).agg(F.sum(F.when(F.shiftright(h, 40) % 2 == 0, 1.0).otherwise(-1.0)).alias("n"))
    want = {i: [0.0] * 16 for i in range(62)}
    for r in sums.collect():
        want[r["id"]][r["b"]] = r["n"]
    assert got == want


def test_frequent_shingles_reach_the_driver_packed(spark, monkeypatch):
    """The driver made a row of each frequent shingle."""
    def unpacked(*_):
        raise AssertionError("a row per shingle")

    rows = [(2**63 - 1 - i, t) for i in range(50) for t in (3, i % 10)] + [(None, 90), (-1, 8), (-2, 7)]
    found = spark.createDataFrame(rows, "member long, texts long").repartition(5)
    monkeypatch.setattr(type(found), "toPandas", unpacked)
    want = sorted(m % 2**64 for m in {m for m, _ in rows if m is not None} if sum(t for x, t in rows if x == m) >= jaccard.FREQUENT_LEAST)
    assert jaccard.frequent_members(found, 1000).tolist() == want
    assert jaccard.frequent_members(found.limit(0), 0).tolist() == []
