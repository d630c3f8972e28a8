import random

import numpy as np
import pytest
from quillon.llm import negatives


def brute(rows, anchors, k=5):
    """rows: (id, label, whole numbers)."""
    out = []
    for a, label, v in dict.fromkeys(anchors):
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:k]:
            below = [(-t, n) for t, n, other in scored if other != label and 80 * -s <= 100 * -t <= 100 * -s]
            out += [(a, p, r + 1, n, -s, t) for r, (t, n) in enumerate(below[:k])]
    return sorted(out)


def whole(v, scale=256):
    return tuple(int(np.floor(scale * float(x))) for x in v)


def rows_of(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_query_equals_brute_force(spark, sf):
    rows = []
    for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect():
        if r["label"] is not None and r["embedding"] is not None:
            rows.append((r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], whole(r["embedding"])))
    assert rows_of(negatives.op11_negatives(spark, sf)) == brute(rows, [x for x in rows if x[0] % 100 == 0])


def test_odd_rows_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 128)
    monkeypatch.setattr(negatives, "ANCHORS", 16)
    rng = random.Random(5)
    rows = [(i, 0 if rng.random() < 0.4 else rng.randrange(1, 4), [rng.choice([-0.5, 0.25, 0.5]) for _ in range(6)]) for i in range(900)]
    rows += [(1000, 1, None), (1001, 1, [None, 1.0]), (1002, 2, [float("nan")]), (1003, 2, [float("-inf")]), (1004, None, [0.5]), (None, 1, [0.5]), (1005, 1, []), (1006, 2, [0.5] * 9), (1007, 1, [1e306]), (7, 3, rows[7][2]), (8, rows[8][1], rows[8][2])]
    kinds = "vec_id long, label int, embedding array<double>, rank int, anchor int"
    make = lambda x: spark.createDataFrame([(*r, 1, 2) for r in x], kinds)
    fine = [(i, c, whole(v)) for i, c, v in rows if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) and abs(x) < 1e300 for x in v)]
    asked = [r for r in rows if r[0] is None or r[0] % 30 == 0 or r[0] in (7, 8) or r[0] >= 1000]
    keep = {r[0] for r in asked}
    assert rows_of(negatives.hard_negatives(make(rows).repartition(5), make(asked))) == brute(fine, [x for x in fine if x[0] in keep and (x[0] not in (7, 8) or x in [(i, c, whole(v)) for i, c, v in asked if i in (7, 8)])])
    assert negatives.hard_negatives(make(rows), make([])).count() == 0
    assert negatives.hard_negatives(make([]), make(asked)).count() == 0
    one_label = make([(i, 1, v) for i, _, v in rows[:50]])
    assert negatives.hard_negatives(one_label, one_label).count() == 0


@pytest.mark.parametrize("size", [1, 300, 1 << 20, 1 << 45, 1 << 80])
def test_products_are_exact(size):
    rng = random.Random(size)
    m = np.array([[float(rng.randrange(-size, size + 1)) for _ in range(7)] for _ in range(150)])
    a = np.array([[float(rng.randrange(-size, size + 1)) for _ in range(7)] for _ in range(9)])
    packed = negatives.Packed(m, float(a.min()), float(a.max()))
    assert packed.in_doubles == (size <= 1 << 20)
    want = [[max(-negatives.LONG, min(negatives.LONG, sum(int(x) * int(y) for x, y in zip(r, s)))) for s in m] for r in a]
    assert packed.scores(a).tolist() == want
    zero = negatives.Packed(m, 0.0, 0.0)
    assert not zero.scores(np.zeros((2, 7))).any()


def test_several_candidates_share_a_number():
    assert negatives.Packed(np.array([[100.0, -100.0]] * 10), -100.0, 100.0).fields == 3
