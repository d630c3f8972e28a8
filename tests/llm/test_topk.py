import random

import numpy as np
from quillon.llm import topk


def brute(rows, queries, k):
    fix = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            fix.setdefault(i, []).append([int(np.floor(1024 * float(x))) for x in v])
    out = set()
    for i, v in queries:
        if i in fix and v is not None and all(x is not None and np.isfinite(x) for x in v):
            q = [int(np.floor(1024 * float(x))) for x in v]
            scores = [(-sum(a * b for a, b in zip(q, w)), j) for j, ws in fix.items() if j != i for w in ws]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])}
    return out


def rows_of(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def test_query_equals_brute_force(spark, sf):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert rows_of(topk.op8_topk(spark, sf)) == sorted(brute(rows, [x for x in rows if x[0] % 100 == 0], 10))


def test_odd_rows_ties_and_blocks(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.25, 0.5]) for _ in range(9)]) for i in range(1500)]
    rows += [(2000 + i, [rng.gauss(0, 0.1) for _ in range(9)]) for i in range(800)]
    rows += [(3000, None), (3001, [1.0, None]), (3002, [float("nan")]), (3003, [float("inf")] * 9), (3004, []), (3005, [0.5]), (3006, [1e7] * 9), (3007, [-0.5] * 12), (5, rows[5][1]), (None, [1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    asked = [x for x in rows if x[0] is not None and x[0] % 50 == 0 or x[0] in range(3000, 3008)]
    got = rows_of(topk.top_k(df, spark.createDataFrame(asked, "vec_id long, embedding array<double>"), k=7))
    assert got == sorted(brute(rows, asked, 7))
    few = df.filter("vec_id < 3")
    assert len(rows_of(topk.top_k(few, few))) == 6
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_search_of_one_block():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    m = np.floor(1024 * x).astype(np.int64)
    ids = rng.permutation(3000)
    order = np.argsort(m, axis=0, kind="stable")
    segments = []
    for d in range(64):
        v = m[order[:, d], d]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(v // 64)) + 1, [3000]])
        segments += [(d, i, j, v[i], v[j - 1]) for i, j in zip(cut[:-1], cut[1:])]
    for r in range(0, 3000, 150):
        want = sorted((-int(s), int(i)) for s, i in zip(m @ m[r], ids) if i != ids[r])[:10]
        got = topk.search(m[r], ids, m, order.T, np.array(segments), ids[r], 10)
        assert [(-s, i) for s, i in got] == want
