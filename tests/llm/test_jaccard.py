import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quillon.llm import jaccard, shingles
from quillon.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def sets_of(text, k):
    w = words_of(text)
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, k, num, den):
    """(id, size, smallest id of the class) by comparing all pairs that share a shingle."""
    sets = [sets_of(t, k) for _, t in rows]
    names = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    posting = defaultdict(list)
    for i, s in enumerate(names):
        for x in s:
            posting[x].append(i)
    root = list(range(len(names)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(names):
        common = defaultdict(int)
        for x in s:
            for j in posting[x]:
                if j < i:
                    common[j] += 1
        for j, n in common.items():
            if den * n >= num * (len(s) + len(names[j]) - n):
                root[find(i)] = find(j)
    index, least = {s: i for i, s in enumerate(names)}, {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            r = find(index[s])
            least[r] = min(least.get(r, i), i)
    return sorted((i, len(s), least.get(find(index[s]), i) if s else i) for (i, _), s in zip(rows, sets))


def test_words_and_blocks():
    rng = random.Random(3)
    texts = ["", " ", "A b c\x1cd\x85e", "x" * 700000 + " y", " ".join("".join(rng.choices("abÄé", k=rng.randint(1, 6))) for _ in range(200000))]
    for t in texts:
        w = words_of(t)
        h = shingles.word_hashes(t)
        assert len(h) == len(w)
        by = {}
        for a, b in zip(w, h.tolist()):
            assert by.setdefault(a, b) == b
        assert len(set(by.values())) == len(by)
        assert len(shingles.shingle_set(t, 3)) == len(sets_of(t, 3))


@pytest.mark.parametrize("ratio", [(90, 100), (80, 100), (1, 2), (1, 1)])
def test_linking_sets_share_a_key(ratio):
    t = jaccard.Threshold(*ratio)
    rng = np.random.default_rng(5)
    for _ in range(400):
        size = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        drop, add = rng.integers(0, size // 6 + 2, 2)
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, int(add)).astype(np.uint64)]))
        if not len(b):
            continue
        n = len(np.intersect1d(a, b))
        link = t.den * n >= t.num * (len(a) + len(b) - n)
        if link:
            for common in (a[:0], a[: size // 4], np.unique(np.concatenate([a[: size // 2], b[: size // 3]])), a):
                key, of = jaccard.list_keys(np.concatenate([a, b]), np.array([len(a), len(b)]), common, t)
                assert len(np.intersect1d(key[of == 0], key[of == 1]))
                alone = [jaccard.list_keys(x, np.array([len(x)]), common, t)[0] for x in (a, b)]
                assert sorted(key.tolist()) == sorted(np.concatenate(alone).tolist())
        small = jaccard.subset_keys(a, t), jaccard.subset_keys(b, t)
        if link and len(small[0]) and len(small[1]):
            assert len(np.intersect1d(*small))


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(300)]
    passage = rng.choices(vocabulary, k=60)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "two one"), (None, "one two"), (7, "w " * 30000), (8, "w " * 30001)]
    i = 10
    for base in range(60):
        words = rng.choices(vocabulary, k=rng.choice([5, 9, 12, 15, 20, 30, 60, 150, 400]))
        if base % 3 == 0:
            words = words[: len(words) // 2] + passage + words[len(words) // 2 :]
        for copy in range(rng.choice([1, 1, 2, 6])):
            w = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w = w[rng.randint(0, 2) :]
            rows.append((i, " ".join(w)))
            i += 1
    words = rng.choices(vocabulary, k=120)  # a large group of near copies
    for _ in range(150):
        w = list(words)
        w[rng.randrange(len(w))] = "q" + str(rng.randrange(60))
        rows.append((i, " ".join(w)))
        i += 1
    rows += [rows[20]] * 3
    return rows


def test_runs_of_texts_are_as_single_texts():
    odd = [None, "", " ", "a", "a b", "é x y z w q", "x" * 700000 + " y z", "a b c d", None, "a\tb c"] * 3
    got = []
    for _, _, members, per in shingles.shingle_groups(pa.array(odd).slice(1), 3):
        assert shingles.set_digests(members, per).tolist() == [shingles.set_digest(x) for x in np.split(members, np.cumsum(per)[:-1])]
        got += [x.tolist() for x in np.split(members, np.cumsum(per)[:-1])]
    assert got == [shingles.shingle_set(x, 3).tolist() for x in odd[1:]]


def test_parities_never_lose_a_link():
    t, rng, seen = jaccard.Threshold(80, 100), np.random.default_rng(4), set()
    for _ in range(600):
        size = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        drop, add = rng.integers(0, size // 5 + 2, 2)
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, int(add)).astype(np.uint64)]))
        n = len(np.intersect1d(a, b))
        x, y = jaccard.parities(np.concatenate([a, b]), np.array([len(a), len(b)]))
        link = len(b) > 0 and t.den * n >= t.num * (len(a) + len(b) - n)
        seen.add(link)
        assert not link or jaccard.may_link(x, y, len(a), len(b), t)
        c = rng.integers(0, 2**63, size).astype(np.uint64)
        assert size < 40 or not jaccard.may_link(x, jaccard.parities(c, np.array([size]))[0], size, size, t)
    assert seen == {True, False}


def test_scanned_lists_count_what_is_common():
    rng = np.random.default_rng(1)
    for n, m, vocabulary in [(1, 1, 5), (3, 40, 50), (60, 200, 400), (60, 200, 30000)]:
        left, right = ([np.unique(rng.integers(0, vocabulary, rng.integers(1, 60))).astype(np.uint64) for _ in range(k)] for k in (n, m))
        want = [[len(np.intersect1d(a, b)) for b in right] for a in left]
        assert jaccard.count_common(left, right).tolist() == want


def test_classes_of_a_block_equal_all_pairs():
    t, rng = jaccard.Threshold(80, 100), np.random.default_rng(2)
    for n in (2, 50, 400):
        base = [rng.integers(0, 2**40, 60).astype(np.uint64) for _ in range(3)]
        sets = []
        for i in range(n):
            x = base[rng.choice(3, p=[0.7, 0.2, 0.1])].copy()
            x[rng.integers(0, 60, rng.integers(0, 14))] += np.uint64(1 + i)
            sets.append(np.unique(x))
        every = jaccard.linked(sets, sets, t)
        assert jaccard.labels(jaccard.classes_of(sets, t), n).tolist() == jaccard.labels(every, n).tolist()


@pytest.mark.parametrize("k,ratio,least", [(3, (90, 100), False), (5, (80, 100), False), (5, (80, 100), True)])
def test_classes_equal_brute_force(spark, k, ratio, least, monkeypatch):
    if least:  # all blocks go the way of large ones, with several sides
        for name, value in (("SIDE_SETS", 8), ("REPRESENTATIVES", 2), ("DENSE", 4), ("FREQUENT_LEAST", 3), ("LIST_MOST", 3)):
            monkeypatch.setattr(jaccard, name, value)
    rows = corpus(k)
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, block long, a string").repartition(5)
    out = jaccard.jaccard_classes(df, words=k, similarity=ratio).collect()
    key = lambda x: (x[0] is not None, x)
    fix = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(fix((r["doc_id"], r["n_shingles"], r["component_id"])) for r in out) == sorted(map(fix, brute_rows(rows, k, ratio)))


def brute_rows(rows, k, ratio):
    # sort keys can't hold None: the null id goes last
    fixed = [(10**9 if i is None else i, t) for i, t in rows]
    return [(None if i == 10**9 else i, n, None if c == 10**9 else c) for i, n, c in brute(fixed, k, *ratio)]


def test_empty_table(spark):
    assert jaccard.jaccard_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.op5_jaccard(spark, sf).collect())
    assert out == brute(docs, 3, 90, 100)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 300)] + [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(200)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in root}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}
