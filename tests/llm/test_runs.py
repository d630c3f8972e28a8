import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from quillon.llm import runs


def brute(words):
    """All runs by comparing the words with themselves, shifted by every period."""
    _, x = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True) if len(words) else (0, np.zeros(0, int))
    found = {}
    for q in range(1, len(x) // 4 + 1):
        same = np.concatenate([[0], (x[:-q] == x[q:]).astype(int), [0]])
        edges = np.flatnonzero(np.diff(same)).reshape(-1, 2)
        for s, e in edges.tolist():
            if e - s + q >= max(6, 4 * q):
                found.setdefault((s, e - s + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_query_equals_brute_force(spark, sf):
    want, sha = [], lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w, h = words_of(r["text"]), zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute(w)
        s, length, q = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        want.append((r["doc_id"], len(found), s, length, q, 1000 * length // q if found else None, sha(lines), sha(collapsed(w, found))))
    got = runs.op13_runs(spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(x[1] for x in want) > 10


def ids(words):
    names = {}
    return np.array([names.setdefault(w, len(names)) for w in words], np.int64)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=12), st.integers(1, 9), st.lists(st.integers(0, 3), max_size=9)), min_size=1, max_size=6))
def test_runs_of_texts_that_share_a_grammar(parts):
    texts = [np.array(a * k + b + a, np.int64) for a, k, b in parts]
    texts += texts[:2]
    for text, got in zip(texts, runs.runs_of(texts)):
        assert [tuple(r) for r in got.tolist()] == brute([str(i) for i in text])


def test_long_and_nested_runs():
    rng = random.Random(3)
    words = [rng.randrange(50) for _ in range(3000)]
    block = words[:40] + [7] * 9 + words[40:60]
    text = words + block * 6 + words[:500] + [1, 2] * 400 + [3] * 1000 + words
    assert [tuple(r) for r in runs.runs_of([ids(text)])[0].tolist()] == brute([str(i) for i in ids(text)])
    assert runs.runs_of([np.zeros(50_000, np.int64)])[0].tolist() == [[0, 50_000, 1]]
    assert runs.runs_of([]) == [] and runs.runs_of([np.zeros(0, np.int64)])[0].tolist() == []


def test_grammar_restores_the_text_and_false_hashes_do_no_harm(monkeypatch):
    rng = random.Random(9)
    x = np.array([rng.randrange(4) for _ in range(2000)] * 3, np.int64)
    g = runs.re_pair(x, 4)

    def words(s):
        return [s] if s < 4 else words(int(g.left[s - 4])) + words(int(g.right[s - 4]))

    assert [w for s in g.start.tolist() for w in words(s)] == x.tolist()
    assert len(g.start) < len(x) / 3 and [x[a] for a in g.nodes.low] == [words(4 + k)[0] for k in range(len(g.left))]
    monkeypatch.setattr(runs.Hashes, "same", lambda self, i, q, n: np.ones(len(i), bool))  # every comparison by hash is wrong or right by chance
    nodes = runs.Nodes(*(np.array([v]) for v in (0, 12, 24)))
    found = runs.crossing(np.array([1, 2, 3] * 6 + [4, 5, 6, 7, 8, 9]), runs.Hashes(np.array([1])), nodes)
    assert found.tolist() == [[0, 0, 18, 3]]


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (3, " \t\n", 3), (None, "a b " * 5, 4), (4, "x " * 6, 5), (4, "x " * 6, 5), (5, "\x0bé\x0cé é é é é é é", 6), (6, "w " * 300_000 + "end", 7)]
    df = spark.createDataFrame(rows, "doc_id int, text string, runs int").withColumnRenamed("runs", "Runs")
    out = runs.find_runs(df)
    assert out.columns == ["doc_id", "text", "runs", "collapsed"]
    got = sorted(((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()))
    assert got == [
        (0, [(0, 10, 2)], "a b"), (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 6, 1)], "x"), (4, [(0, 6, 1)], "x"),
        (5, brute_runs(rows[6][1]), collapsed(words_of(rows[6][1]), brute_runs(rows[6][1]))), (6, [(0, 300_000, 1)], "w end"),
    ]
    assert runs.find_runs(df.limit(0)).count() == 0


def brute_runs(text):
    return brute(words_of(text))
