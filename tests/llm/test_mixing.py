import re

import duckdb
import pytest

from quillon.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by sharing out again and again what is above the caps."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while free and left > 1e-9:
        total = sum(w[s] for s in free)
        give = {s: left * w[s] / total for s in free}
        left = 0.0
        for s, x in give.items():
            target[s] += x
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
    return target


def check(rows, docs):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = water_fill(sizes)
    by, largest = {}, {}
    source = {i: s for i, _, s in docs}
    text = {i: t for i, t, _ in docs}
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == len(WORD.findall(text[r["doc_id"]] or "")) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert r["taken"] <= 2 * r["size"]
        by[s] = by.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
    for s in by:
        assert abs(by[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_query_and_sql(spark, sf):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = mixing.op4_mixing(spark, sf).collect()
    check(rows, docs)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(f"select doc_id, size, source_size, target, taken from ({queries.ORACLES['op4_mixing']})").fetchall())
    got = sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in rows)
    assert [(*x[:3], x[4]) for x in got] == [(*x[:3], x[4]) for x in want]
    assert [x[3] for x in got] == pytest.approx([x[3] for x in want])


def test_odd_rows(spark):
    docs = [(i, "w " * (i % 7 * 30), ["b", "é", None, "a", "Z"][i * i % 5]) for i in range(400)]
    docs += [(1000, None, "a"), (1001, "", "only_empty"), (1002, " \t\n", None), (1003, "x" * 100000 + " y", "one")]
    df = spark.createDataFrame([(i, t, s, 9, 9.0) for i, t, s in docs], "doc_id long, text string, source string, size int, target double").repartition(5)
    a, b = (sorted(map(tuple, mixing.mix_sources(df.repartition(n)).select("doc_id", "taken").collect())) for n in (1, 6))
    assert a == b
    check(mixing.mix_sources(df).collect(), docs)
    assert mixing.mix_sources(df.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (None, "", None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix_sources(nothing).collect()] == [0, 0]


def test_topk_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = sorted(con.execute(f"select query_id, rank, vec_id, score from ({queries.ORACLES['op8_topk']})").fetchall())
    assert sorted(tuple(r) for r in queries.QUERIES["op8_topk"](spark, sf).select("query_id", "rank", "vec_id", "score").collect()) == want
