import random
import time

import numpy as np
from quillon.llm import licenses
from quillon.llm.shingles import words_at

LONG = licenses.NOTICES["GPL-3.0-header"]


def brute(text, texts, coverage=0.8):
    """Names of the templates whose best alignment anywhere in the text covers enough of their words."""
    words, out = words_at(text, plain=True)[0].tolist(), set()
    for name, template in texts.items():
        t = words_at(template, plain=True)[0].tolist()
        if not words:
            continue
        at, w = np.arange(len(words) + 1), np.array(words, np.uint64)
        score = np.zeros(len(words) + 1, np.int64)  # by text words used; matched words as a second digit
        for x in t:
            best = score - 1_000_000
            best[1:] = np.maximum(best[1:], score[:-1] + np.where(w == np.uint64(x), 2_000_001, -1_000_000))
            score = np.maximum.accumulate(best + 1_000_000 * at) - 1_000_000 * at
        top = int(score.max())
        if top % 1_000_000 >= coverage * len(t):
            out.add(name)
    return out


def names(found):
    return {x[0] for x in found}


def test_exact_and_edited_matches_with_spans():
    index = licenses.Index.build(licenses.NOTICES)
    rng = random.Random(4)
    filler = [f"w{i}" for i in range(500)]
    for name, text in licenses.NOTICES.items():
        for prefix in ["", "é ü " * 7, " ".join(rng.choices(filler, k=300)) + "\n"]:
            whole = prefix + text + " " + " ".join(rng.choices(filler, k=20))
            hit = [x for x in licenses.find(whole, index, 0.8) if x[0] == name]
            assert len(hit) == 1 and hit[0][1] == 1.0
            assert whole[hit[0][3] : hit[0][4]].rstrip('.("') in text and hit[0][3] == len(prefix)
    words = LONG.split()
    for _ in range(60):
        w = list(words)
        for _ in range(3):
            i = rng.randrange(1, len(w) - 1)
            rng.choice([lambda: w.pop(i), lambda: w.insert(i, "zz"), lambda: w.__setitem__(i, "yy")])()
        before = rng.choices(filler, k=rng.randrange(200))
        found = [x for x in licenses.find(" ".join(before + w + before), index, 0.8) if x[0] == "GPL-3.0-header"]
        assert len(found) == 1 and found[0][1] >= 0.85


def test_clean_texts_and_repeats():
    index = licenses.Index.build(licenses.NOTICES)
    assert licenses.find("this work is about the general public and its rights", index, 0.8) == []
    assert licenses.find("", index, 0.8) == [] and licenses.find("all rights", index, 0.8) == []
    assert len(licenses.find("All rights reserved. x y z q. " * 50, index, 0.8)) == 50


def test_query_finds_every_notice(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {(r["doc_id"], r["license"], r["start"]): r for r in licenses.op7_licenses(spark, sf).collect()}
    for i, text in docs.items():
        for name in ("MIT-notice", "Apache-2.0-notice", "GPL-3.0-notice", "All-rights-reserved"):
            at = text.find(licenses.NOTICES[name])
            if at >= 0:
                assert got[i, name, at]["coverage"] == 1.0


def test_odd_rows(spark):
    rows = [(None, LONG, 1), (1, None, 1), (2, "", 1), (3, "x " * 200000 + LONG, 1), (3, "x " * 200000 + LONG, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    out = licenses.scan_licenses(df).collect()
    assert sorted((str(r["doc_id"]), r["license"]) for r in out) == [("3", "GPL-3.0-header")] * 2 + [("None", "GPL-3.0-header")]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_table_and_edited_copies_equal_brute_force(spark, sf):
    index, rng = licenses.Index.build(licenses.NOTICES), random.Random(9)
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect() if r["text"] and len(r["text"]) < 6000][:150]
    filler = [w for t in texts[:20] for w in t.split()]
    for name, text in licenses.NOTICES.items():
        for share in (0.05, 0.1, 0.3, 0.5):
            w = text.split()
            for _ in range(round(share * len(w))):
                i = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(i, "zz"), lambda: w.__setitem__(i, rng.choice(filler)), lambda: w.insert(i, "zz")])()
            texts.append(" ".join([*rng.choices(filler, k=40), *w, *rng.choices(filler, k=40)]))
    for t in texts:
        assert names(licenses.find(t, index, 0.8)) == brute(t, licenses.NOTICES), t[:200]


def test_full_texts():
    every = licenses.templates()
    index = licenses.Index.build(every)
    assert {"Apache-2.0", "GPL-3.0", "MPL-2.0", "MIT", "BSD-3-Clause"} <= set(every)
    for name in ("Apache-2.0", "GPL-3.0", "MPL-2.0", "LGPL-2.1"):
        words = every[name].split()
        for k in range(0, len(words), 40):
            words[k] = "changed"
        began = time.process_time()
        found = licenses.find("some text before it " * 50 + " ".join(words) + " and after it" * 50, index, 0.8)
        assert time.process_time() - began < 3
        assert [x[0] for x in found if x[0] == name and 0.95 < x[1] < 1] == [name]
    clean = "the terms of the software and the rights of the people in the form of a work " * 4000
    began = time.process_time()
    assert not names(licenses.find(clean, index, 0.8)) & {"GPL-3.0", "Apache-2.0"}
    assert time.process_time() - began < 3


def matches(found, name):
    return [x for x in found if x[0] == name]


def test_full_texts_with_long_insertions_and_deletions():
    every = licenses.templates()
    index, rng = licenses.Index.build(every), random.Random(11)
    other = [f"other{i}" for i in range(3000)]
    for name in ("GPL-3.0", "Apache-2.0", "MPL-2.0", "MIT", "BSD-3-Clause"):
        text = every[name]
        words, n = text.split(), len(words_at(text, plain=True)[0])
        for length in (100, 200, 1000, 5000):
            at = rng.randrange(len(words) // 5, 4 * len(words) // 5)
            found = matches(licenses.find(" ".join(["before"] * 30 + words[:at] + rng.choices(other, k=length) + words[at:]), index, 0.8), name)
            assert len(found) == 1 and found[0][2] >= n - 12, (name, length)  # at the cut another of equal alignments may win
        several = sorted(rng.sample(range(len(words)), 2))
        mixed = words[: several[0]] + rng.choices(other, k=700) + words[several[0] : several[1]] + rng.choices(other, k=90) + words[several[1] :]
        found = matches(licenses.find(" ".join(mixed), index, 0.8), name)  # a piece of few words may be left aside
        assert len(found) == 1 and found[0][1] >= 0.9
        cut = rng.randrange(len(words) // 2)
        gone = len(words) // 10
        left = matches(licenses.find(" ".join(words[:cut] + words[cut + gone :]), index, 0.8), name)
        assert len(left) == 1 and 0.88 <= left[0][1] <= 0.92
        assert not matches(licenses.find(" ".join(words[:cut] + words[cut + 3 * gone :]), index, 0.8), name)
    lines = every["GPL-3.0"].splitlines()
    for k in range(0, len(lines), 50):
        lines[k] = "Some Project - License - page header line\n" + lines[k]
    assert [x[1] for x in matches(licenses.find("\n".join(lines), index, 0.8), "GPL-3.0")] == [1.0]


def test_many_copies_are_many_matches_in_little_time():
    every = licenses.templates()
    index, words = licenses.Index.build(every), every["GPL-3.0"].split()
    began = time.process_time()
    plain = licenses.find("\n\n".join([every["GPL-3.0"]] * 20), index, 0.8)
    assert time.process_time() - began < 3
    assert len(matches(plain, "GPL-3.0")) == 20 and all(x[1] == 1.0 for x in matches(plain, "GPL-3.0"))
    half = len(words) // 2
    broken = " ".join([*words[:half], *["x"] * 300, *words[half:], *["y"] * 400] * 3)
    found = matches(licenses.find(broken, index, 0.8), "GPL-3.0")
    assert len(found) == 3 and all(x[1] == 1.0 for x in found)


def test_chains_ascend_in_both():
    rng = random.Random(2)
    for _ in range(200):
        pairs = np.array([(rng.randrange(8), rng.randrange(8)) for _ in range(rng.randrange(1, 12))])
        best = 0
        for mask in range(1 << len(pairs)):
            some = sorted(map(tuple, pairs[[i for i in range(len(pairs)) if mask >> i & 1]].tolist()))
            if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(some, some[1:])):
                best = max(best, len(some))
        got = licenses.chained(pairs).tolist()
        assert len(got) == best and all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))
    assert len(licenses.chained(np.zeros((0, 2), np.int64))) == 0
