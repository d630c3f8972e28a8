import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quillon.llm import langid, token_counts


def test_langid_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = langid.op10_language_id(spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    kept = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in kept) > 0.98 * len(kept)


def plain_vector(text):
    """A text's bundle, trigram by trigram, letter by letter."""
    base = np.random.default_rng(langid.SEED).integers(0, 2, (langid.CLASSES, langid.DIM), dtype=np.int8) * 2 - 1
    codes = [0]
    for c in text:
        if c.isalpha():
            low = ord(c.lower()[0])
            codes.append(low - 96 if 97 <= low <= 122 else 27 + low * 2654435761 % 2**32 % (langid.CLASSES - 27))
        elif codes[-1]:
            codes.append(0)
    codes += [0] if codes[-1] else []
    out = np.zeros(langid.DIM)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        out += np.roll(base[a], 2).astype(float) * np.roll(base[b], 1) * base[c]
    return out


def test_predictions_equal_a_plain_computation(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(1)
    scripts = {"ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "el": "αβγδεζηθικλμνξοπρστυφχψω", "hy": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ"}
    extra, number = [], 10**6
    for lang, letters in scripts.items():
        words = ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(60)]
        for _ in range(40):
            extra.append((number, " ".join(rng.choices(words, k=30)), lang))
            number += 1
    every = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    rows = [tuple(r) for r in every.collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    sums = {}
    for i, text, lang in rows:
        if lang is not None and text and not held(i):
            v = plain_vector(text)
            if (size := np.linalg.norm(v)) > 0:
                sums[lang] = sums.get(lang, 0) + np.rint(v * (langid.PARTS / size))
    langs = sorted(sums)
    prototypes = np.array([sums[x] / np.linalg.norm(sums[x]) for x in langs])
    got = {r["doc_id"]: r for r in langid.identify(every).collect()}
    right = 0
    for i, text, lang in rows:
        v = plain_vector(text or "")
        if not text or not any(c.isalpha() for c in text):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        cos = prototypes @ v / max(np.linalg.norm(v), 1e-12)
        assert abs(got[i]["score"] - min(1, max(0, cos.max()))) < 1e-6
        assert got[i]["lang_pred"] == langs[int(cos.argmax())] or np.sort(cos)[-1] - np.sort(cos)[-2] < 1e-6
        right += lang in scripts and held(i) and got[i]["lang_pred"] == lang
    assert right == sum(held(i) for i, _, _ in extra)


def test_langid_odd_rows(spark):
    rows = [(i, "the words of the house and the garden " * 3, "en") for i in range(30)] + [(100 + i, "das haus und der garten mit den worten " * 3, "de") for i in range(30)]
    rows += [(None, None, "en"), (201, "", None), (202, "123 !!", "de"), (203, "Ж" * 300000, None), (1, rows[1][1], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "'x' as held_out")
    out = langid.identify(df).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r["lang_pred"] for r in out}
    assert by[None] == by[201] == by[202] == "und" and by[5] == "en" and by[105] == "de"
    assert langid.identify(df.limit(0)).count() == 0
    none = langid.identify(df.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def test_token_counts_equal_tokenizer_offsets(spark, sf):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = defaultdict(dict)
    for r in token_counts.op9_token_counts(spark, sf).collect():
        got[r["doc_id"]][r["start"]] = r["n_tokens"]
    for i, text in docs.items():
        lines, at = [], 0
        for line in text.split("\n"):
            lines.append(at)
            at += len(line) + 1
        lines = [x for x in lines if x < len(text)] or [0]
        want = dict.fromkeys(lines, 0)
        for s, _ in tok.encode(text, add_special_tokens=False).offsets:
            want[max(x for x in lines if x <= s)] += 1
        assert got[i] == want


def test_token_count_rules(spark):
    rows = [(1, "hello wörld 中文 and more", [3, 8, 13]), (2, None, [1]), (3, "", None), (1, "x", []), (None, "abc " * 50000, [7])]
    df = spark.createDataFrame(rows, "doc_id long, text string, cuts array<long>")
    total = {}
    for rule in token_counts.RULES:
        out = token_counts.count_tokens(df, sections_col="cuts", rule=rule).collect()
        total[rule] = round(sum(r["n_tokens"] for r in out), 6)
        assert sum(r["end"] - r["start"] for r in out) == sum(len(t or "") for _, t, _ in rows)
    assert total["start"] == total["most"] == total["share"]
    assert token_counts.count_tokens(df.limit(0)).count() == 0
