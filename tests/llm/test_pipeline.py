import hashlib
import random
import zlib
from collections import Counter

import corpus_pipeline as cp
import numpy as np
from quillon.llm import common, mixing
from quillon.llm.common import save
from quillon.llm.langid import letter_classes
from test_jaccard import WORD, brute
from test_packing import verify
from test_secrets_chat import brute as brute_secrets
from test_secrets_chat import brute_linked

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_stages_one_by_one(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(10**6, None, "en", "src0", 0), (10**6 + 1, "123 456", None, None, 7), (10**6 + 2, "", "en", None, 0)]
    docs = save(docs.select(*COLUMNS).unionByName(spark.createDataFrame(extra, docs.select(*COLUMNS).schema)), "t")
    first = save(cp.language_stage(spark, docs, sf), "t")
    assert first.columns == COLUMNS
    assert Counter(rows_of(first)) == Counter(r for r in rows_of(docs) if r[0] < 10**6)  # clean texts stay

    second = save(cp.duplicate_stage(spark, first, sf), "t")
    keep = {c for *_, c in brute([(r[0], r[1]) for r in rows_of(first)], 5, 80, 100)}
    assert Counter(rows_of(second)) == Counter(r for r in rows_of(first) if r[0] in keep)

    third = save(cp.secret_stage(spark, second, sf), "t")
    was = {r[0]: r for r in rows_of(second)}
    assert len(rows_of(third)) == len(was)
    for r in rows_of(third):
        assert not brute_secrets(r[1]) and r[4] == (len(r[1]) if r[1] != was[r[0]][1] else was[r[0]][4])
        assert brute_secrets(was[r[0]][1]) or r == was[r[0]]

    fourth = save(cp.mixing_stage(spark, third, sf), "t")
    taken = {r["doc_id"]: r["repeats"] for r in mixing.mix_sources(third).collect()}
    assert Counter(rows_of(fourth)) == Counter({r: taken[r[0]] for r in rows_of(third) if taken[r[0]]})

    verify(cp.packing_stage(spark, fourth, sf).collect(), [(r[0], r[1]) for r in rows_of(fourth)], special=True)


def test_repeated_ids_and_empty_tables(spark):
    text = "a b c d e f g h i j k l " * 4
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (1, "quite another text that says other things", "en", "s", 5), (None, text, "en", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert cp.duplicate_stage(spark, docs, "").count() == 2
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0


def plain_mix(rows):
    """How often each row is taken, by sorting each source by hash; (repeats by doc_id)."""
    words = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r[0])
    order = sorted((s for s in by if s is not None)) + ([None] if None in by else [])
    size = {s: sum(words[i] for i in by[s]) for s in order}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, budget = {}, list(order), 1.5 * sum(size.values())
    while free:  # what is above a cap goes to the others
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * size[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in over}
        free = [s for s in free if s not in over]
    taken = {}
    for s in order:
        rounds = int(target[s] // size[s]) if size[s] else 0
        left, before = target[s] - rounds * size[s], 0
        for i in sorted(by[s], key=lambda i: hashlib.md5(str(i).encode()).hexdigest()):
            taken[i] = rounds + (left > 0 and before + words[i] / 2 <= left)
            before += words[i]
    return taken


def test_run_equals_a_plain_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = {r[0] for r in rows_of(cp.language_stage(spark, docs, sf))}  # see the test of this stage below
    rows = {r[0]: r for r in rows_of(docs) if r[0] in known}
    rows = {i: r for i, _, c in brute([(r[0], r[1]) for r in rows.values()], 5, 80, 100) if i == c for r in [rows[i]]}
    clean = {}
    for i, r in rows.items():
        out, at, text = [], 0, r[1] or ""
        for s, e in sorted([(s, e) for s, _, _, e in brute_secrets(text)] + [(s, e) for s, e, _ in brute_linked(text)]):
            if s >= at:
                out += [text[at:s], "[SECRET]"]
            at = max(at, e)
        clean[i] = (i, "".join([*out, text[at:]]), *r[2:])
    taken = plain_mix(list(clean.values()))
    verify(cp.run(spark, sf).collect(), [(i, r[1]) for i, r in clean.items() for _ in range(taken[i])], special=True)


def test_odd_columns_and_texts(spark):
    long = "word " * 150_000 + "user=alice pwd=hunter22 " * 3
    rows = [(i, f"the words of the house and the garden number {i} " * 3, "en", "s", 5, 1, 2, 3, 4, 5, 6) for i in range(30)]
    rows += [(100, long, None, None, 5, 1, 2, 3, 4, 5, 6), (101, None, "en", "s", None, 1, 2, 3, 4, 5, 6), (102, "", None, "s", 0, 1, 2, 3, 4, 5, 6), (5, *rows[5][1:])]
    names = "doc_id long, text string, lang string, source string, n_chars long, _doc int, _ROW int, _kept int, _length int, _time int, component_id int"
    docs = spark.createDataFrame(rows, names)
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        got = {r["doc_id"]: r for r in out.collect()}
        assert set(got) <= {r[0] for r in rows} and all(r["_doc"] == 1 and r["_time"] == 5 and r["component_id"] == 6 for r in got.values())
    assert stage is cp.mixing_stage
    assert {r["doc_id"] for r in cp.packing_stage(spark, docs, "").collect()} == {r[0] for r in rows}


def trigrams_of(text):
    """Distinct trigrams over letter classes, as tuples."""
    table, word = letter_classes(), [0]
    for c in text or "":
        k = int(table[ord(c)])
        if k or word[-1]:
            word.append(k)
    word += [0] if word[-1] else []
    return {tuple(word[i : i + 3]) for i in range(len(word) - 2)}


def test_language_stage_drops_what_is_in_no_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS)
    rng = random.Random(5)
    letters = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    odd = ["asdf qwer zxcv hjkl", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw", "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar"]
    odd += [letters("bcdfghjklmnpqrstvwxz", 500) for _ in range(20)] + [letters("abcdefghijklmnopqrstuvwxyz    ", 5000) for _ in range(20)]
    odd += [letters([chr(first + i) for i in range(24)], n) for first in (0x430, 0x3B1, 0x4E00) for n in (50, 500, 5000) for _ in range(5)]
    words = ["The.", "De.", "Avec.", "This.", "the of the and"]
    both = " ".join(r["text"] for lang in ("en", "fr", "de") for r in docs.filter(f"lang = '{lang}'").orderBy("doc_id").limit(2).collect())
    extra = [(10**6 + i, t, None, "s", len(t)) for i, t in enumerate([*odd, *words, both])]
    every = docs.unionByName(spark.createDataFrame(extra, docs.schema))

    rows = [r for r in rows_of(docs) if r[1]]
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    texts = {lang: Counter(t for r in rows if r[2] == lang and not held(r[0]) for t in trigrams_of(r[1])) for lang in {r[2] for r in rows}}
    n = Counter(r[2] for r in rows if not held(r[0]))
    familiar = {t for lang, c in texts.items() for t, k in c.items() if k >= 0.001 * n[lang]}
    shares = sorted(1 - len(t & familiar) / len(t) for r in rows if held(r[0]) and len(t := trigrams_of(r[1])) >= 64)
    share = min(0.5, max(0.15, float(np.quantile(shares, 0.999))))
    fits = lambda t: bool(t) and len(t - familiar) <= share * len(t) + 3 * (share * (1 - share) * len(t)) ** 0.5

    got = {r[0] for r in rows_of(cp.language_stage(spark, every, ""))}
    assert got == {r[0] for r in [*rows, *extra] if fits(trigrams_of(r[1]))}
    assert {i - 10**6 for i in got if i >= 10**6} == {*range(len(odd), len(extra))}


def test_a_failed_stage_leaves_no_tables(spark):
    df = spark.range(5)
    try:
        with common.scratch(spark) as kept:
            kept.append(common.save(df, "kept"))
            left = common.save(df, "left")
            raise RuntimeError("stage")
    except RuntimeError:
        pass
    assert left._saved_at not in common._paths and kept[0]._saved_at not in common._paths
    with common.scratch(spark) as kept:
        kept.append(common.save(df, "kept"))
        left = common.save(df, "left")
    assert left._saved_at not in common._paths and kept[0].count() == 5
    common.drop(kept[0])
