import zlib
from array import array
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillon.llm import packing, token_counts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_best_fit_and_counts(sizes):
    where, off, used = packing.best_fit(np.array(sizes, np.int64), 40)
    check([(int(w), int(o), s) for w, o, s in zip(where, off, sizes)], sizes, 40)
    seen, items = Counter(), []
    for s, lo, hi, first, off in packing.pack_counts(dict(Counter(sizes)), 40):
        assert lo == seen[s]
        seen[s] = hi
        items += [(first + k, off, s) for k in range(hi - lo)]
    assert seen == Counter(sizes)
    check(items, sizes, 40)


def check(items, sizes, capacity):
    assert sorted(s for *_, s in items) == sorted(sizes)
    by = {}
    for b, o, s in items:
        by.setdefault(b, []).append((o, s))
    for parts in by.values():
        at = 0
        for o, s in sorted(parts):
            assert o == at
            at += s
        assert at <= capacity
    return by


def reference(text, tok):
    return [*tok.encode(text or "", add_special_tokens=False).ids, 0]


def verify(rows, docs, capacity=2048, special=False):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = not special  # without ``special`` the added token's string is ordinary text
    want = Counter()
    for i, t in docs:
        ids = reference(t, tok)
        n = -(-len(ids) // capacity)
        start = 0
        for p in range(n):
            length = len(ids) - capacity * (n - 1) if p == 0 else capacity
            want[(i, p, start, length, zlib.crc32(array("I", ids[start : start + length])))] += 1
            start += length
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = check([(r["sequence_id"], r["offset"], r["length"]) for r in rows], [r["length"] for r in rows], capacity)
    return len(by), -(-sum(r["length"] for r in rows) // capacity)


def test_query(spark, sf):
    rows = packing.op1_packing(spark, sf).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    used, least = verify(rows, docs, special=True)
    assert used <= least * 1.03 + 1


def test_odd_rows_over_many_partitions(spark):
    texts = [None, "", "<|endoftext|> x", "wörd " * 9000, " " * 5000, *["a b c " * k for k in range(1, 300, 7)], *["same text here " * 250] * 40]
    docs = [(i if i % 5 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, 3, "x") for i, t in docs], "doc_id long, text string, piece int, bin string").repartition(23)
    rows = packing.pack_documents(df).collect()
    used, least = verify(rows, docs)
    assert used <= least * 1.15 + 2
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = [(i, "some words and more " * (i % 90)) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    packed = packing.pack_documents(df, capacity=256)
    rows = packed.collect()
    ids = {r["sequence_id"]: r["ids"] for r in packing.packed_ids(df, packed).collect()}
    for r in rows:
        got = ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(array("I", got)) == r["ids_crc32"]


ENDS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x\nwörd <|endoftext|", "中文 " * 3000 + "<|endoftext|>\n\n", "none"]


def test_queries_know_the_added_token(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(ENDS)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in enumerate(ENDS):
        ids = reference(t, tok)
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want.update((i, p, a, b - a, zlib.crc32(array("I", ids[a:b]))) for p, (a, b) in enumerate(zip(cuts, cuts[1:])))
    for packed in (packing.op1_packing(spark, str(tmp_path)), corpus_pipeline.packing_stage(spark, df, "")):
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed.collect()) == want
    got = {(r["doc_id"], r["start"]): r["n_tokens"] for r in token_counts.op9_token_counts(spark, str(tmp_path)).collect()}
    lines = Counter()
    for i, t in enumerate(ENDS):
        starts = [k for k in range(len(t)) if k == 0 or t[k - 1] == "\n"]
        lines.update({(i, k): 0 for k in starts})
        lines.update((i, max(k for k in starts if k <= s)) for s, _ in tok.encode(t, add_special_tokens=False).offsets)
    assert got == dict(lines)
