import numpy as np
import pytest

from quillon.llm import neardup


def brute(rows, cosine):
    width = max((len(v) for _, v in rows if v is not None), default=1)
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.zeros((len(ok), width))
    for k, i in enumerate(ok):
        x[k, : len(rows[i][1])] = rows[i][1]
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(ok) else x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= cosine
    np.fill_diagonal(link, False)
    root = list(range(len(ok)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*np.nonzero(link)):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    least = {}
    for k, i in enumerate(ok):
        if rows[i][0] is not None:
            least[find(k)] = min(least.get(find(k), rows[i][0]), rows[i][0])
    place = {i: k for k, i in enumerate(ok)}
    out = []
    for i, (name, _) in enumerate(rows):
        c = least.get(find(place[i]), name) if i in place else name
        out.append((name, int(link[place[i]].sum()) if i in place else 0, c, None if name is None else name == c))
    return sorted(out, key=str)


def vectors(width, seed, n=700):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, width))
    out = [*base]
    for k in range(40):  # groups around the threshold, far within it, and exact copies
        for noise in (0.02, 0.2, 0.35, 0.5, 0.6):
            out.append(base[k] + noise * np.linalg.norm(base[k]) / np.sqrt(width) * rng.normal(size=width))
    out += [base[3] * 2, base[3].copy(), base[3].copy()]
    out += [base[9] + 0.1 * rng.normal(size=width) for _ in range(120)]
    return [[float(x) for x in v] for v in out]


@pytest.mark.parametrize("width,bits,cosine", [(64, None, 0.9), (64, 3, 0.9), (10, 2, 0.9), (3, 1, 0.95), (1, None, 0.9), (64, 2, 0.7)])
def test_links_equal_brute_force(spark, width, bits, cosine):
    rows = list(enumerate(vectors(width, width + (bits or 0))))
    if width == 10:
        rows += [(None, rows[3][1]), (90000, None), (90001, []), (90002, [0.0] * 10), (90003, [1.0, None]), (90004, [float("nan")] * 10), (90005, [float("inf")]), (90006, rows[5][1][:7]), (90007, [1e300] * 10), (90008, [1e-300] * 10), (4, rows[4][1])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, node int, label int").repartition(3)
    got = neardup.near_duplicates(df, cosine=cosine, bits=bits).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, cosine)


def test_query_and_empty_table(spark, sf):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in neardup.op2_neardup(spark, sf).collect()), key=str) == brute(rows, 0.9)
    assert neardup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
