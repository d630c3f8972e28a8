"""Exact top-k search by inner product over an impact-ordered, score-at-a-time index.

The index holds blocks of rows.  In a block every dimension has posting segments: the rows whose
component is in one quantisation level.  A query's segments are processed by descending impact (the
most that a component of the level can add to the score), so accumulators are upper bounds of the
part seen so far.  What is unseen adds at most the next impact for each dimension, and no more than that
dimension's largest; once the rows whose bound reaches the k-th best exact score are few, or nothing
positive is left, those rows are scored exactly and the rest is proven out.

Every query meets one block first, whose k-th best score is a threshold for all others: a block whose
bound stays below it is skipped, and in the others proofs hold earlier.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import save

#: Rows of an index block, queries of a query block, levels of a dimension.
ROWS, QUERIES, LEVELS = 16_384, 512, 32
#: Parts of the positive impacts after which a proof is tried.
PROOFS = (0.5, 0.7, 0.85, 1.0)
#: Scores are summed in 64 bits as long as no product sum can pass this.
EXACT = 1 << 62


def usable(v: Column) -> Column:
    """Vectors that take part: not null, and without null or non-finite components."""
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def quantised(v: Column, scale: int) -> Column:
    return F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def _matrix(lists: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def build_index(rows: DataFrame) -> DataFrame:
    """(key, n, width, ids, values, posting, segments): one row per block of (id, v) rows.

    ``posting`` has, dimension by dimension, the block's rows by level; ``segments`` has (dimension,
    first posting, end, least value, largest value) of each level.  Shorter vectors end in zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, key = [], [], TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            nonlocal ids, vectors, key
            width = max(map(len, vectors))
            m = _matrix(vectors, width)
            order = np.argsort(m, axis=0, kind="stable").astype(np.int32)
            low, high = m.min(axis=0), m.max(axis=0)
            segments = []
            for d in range(width):
                values = m[order[:, d], d]
                step = (int(high[d]) - int(low[d])) // LEVELS + 1
                level = (values - low[d]) // step
                cut = np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1, [len(values)]])
                segments.append(np.stack([np.full(len(cut) - 1, d), cut[:-1], cut[1:], values[cut[:-1]], values[cut[1:] - 1]], 1))
            found = [key, len(ids), width, np.array(ids, np.int64).tobytes(), m.tobytes(), order.T.tobytes(), np.concatenate(segments).tobytes() if segments else b""]
            ids, vectors, key = [], [], key + 1
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(found, [*[pa.int64()] * 3, *[pa.binary()] * 4])], ["key", "n", "width", "ids", "values", "posting", "segments"])

        for b in batches:
            ids += b.column("id").to_pylist()
            vectors += b.column("v").to_pylist()
            while len(ids) >= ROWS:
                more = ids[ROWS:], vectors[ROWS:]
                ids, vectors = ids[:ROWS], vectors[:ROWS]
                yield flush()
                ids, vectors = more
        if ids:
            yield flush()

    return rows.select("id", "v").mapInArrow(run, "key long, n long, width long, ids binary, values binary, posting binary, segments binary")


def search(q: np.ndarray, ids: np.ndarray, m: np.ndarray, posting: np.ndarray, segments: np.ndarray, own: int | None, k: int, floor: int | None = None) -> list[tuple[int, int]]:
    """(score, id) of the block's k best rows for one query, ties to the smaller id.

    With ``floor``, rows that score less may be left out.
    """
    n, width = m.shape
    q = q[:width]
    rows = np.arange(n) if own is None else np.flatnonzero(ids != own)
    if int(np.abs(q).max(initial=0)) * int(np.abs(m).max(initial=0)) * max(1, width) >= EXACT:  # Python's whole numbers
        scores = [sum(int(a) * int(b) for a, b in zip(q, m[r])) for r in rows]
        return sorted(((s, int(ids[r])) for s, r in zip(scores, rows)), key=lambda x: (-x[0], x[1]))[:k]
    if len(rows) > 4 * k:
        weight = q[segments[:, 0]]
        impact = np.maximum(weight * segments[:, 3], weight * segments[:, 4])
        most = np.full(width, -EXACT)  # of each dimension
        np.maximum.at(most, segments[:, 0], impact)
        if floor is not None and most.sum() < floor:
            return []
        order = np.argsort(-impact, kind="stable")
        positive = int((impact > 0).sum())
        bound = np.zeros(n, np.int64)
        if own is not None:
            bound[ids == own] = -EXACT
        at = 0
        for part in PROOFS:
            end = int(np.ceil(positive * part))
            for s in order[at:end].tolist():
                d, i, j = segments[s, :3]
                bound[posting[d, i:j]] += impact[s]
            at = end
            # an unseen component adds at most the next impact and its dimension's largest, or nothing
            rest = int(np.clip(most, 0, max(0, int(impact[order[at]]))).sum()) if at < len(order) else 0
            best = np.argpartition(bound, n - 2 * k)[n - 2 * k :]
            best = best[bound[best] > -EXACT // 2]
            least = np.partition(m[best] @ q, len(best) - k)[len(best) - k]
            least = least if floor is None else max(least, floor)
            rows = np.flatnonzero(bound + rest >= least)
            if own is not None:
                rows = rows[ids[rows] != own]
            if len(rows) <= max(8 * k, n // 100):
                break
    scores = m[rows] @ q
    top = np.lexsort((ids[rows], -scores))[:k]
    return [(int(scores[t]), int(ids[rows[t]])) for t in top]


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, id, score): each query's ``k`` highest inner products with rows of ``vectors``.

    Components are floor(scale * x).  Rows with the query's id are left out; ties go to the smaller
    id.  Null vectors and vectors with null or non-finite components take no part on either side,
    repeated queries count once, repeated rows are rows, and with fewer than ``k`` rows all come
    back; an empty table gives no rows.  Packs of queries go to blocks of rows, each pair in one task
    step, which hands on ``k`` rows per query at most; the index is shuffled once, whatever the number
    of queries.
    """
    pick = lambda df: df.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"))
    index = save(build_index(pick(vectors)), "topk-index")
    number = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("_key")) - 1  # a row per block
    number = index.select(F.col("key").alias("_key")).withColumn("block", number)
    index, blocks = index.join(number, F.col("key") == F.col("_key")).drop("key", "_key"), max(1, index.count())
    asked = save(pick(queries).distinct(), "topk-queries")
    packs = max(1, -(-asked.count() // QUERIES))
    asked = asked.withColumn("pack", F.pmod(F.xxhash64("id", "v"), F.lit(packs)).cast("int")).withColumn("number", F.xxhash64("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                cell = lambda c: b.column(c)[r].as_py()  # noqa: B023, E731
                n, width = cell("n"), cell("width")
                ids, m = np.frombuffer(cell("ids"), np.int64), np.frombuffer(cell("values"), np.int64).reshape(n, width)
                posting = np.frombuffer(cell("posting"), np.int32).reshape(width, n)
                segments = np.frombuffer(cell("segments"), np.int64).reshape(-1, 5)
                out = []
                for x in cell("queries"):
                    q = np.zeros(max(width, len(x["v"])), np.int64)
                    q[: len(x["v"])] = x["v"]
                    out += [(x["id"], x["number"], i, s) for s, i in search(q, ids, m, posting, segments, x["id"], k, x["floor"])]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(4)], ["query_id", "_query", "_id", "score"])

    def meet(rows: DataFrame, where: Column) -> DataFrame:
        """Best rows of the blocks ``where`` for each query; rows has (id, v, number, pack, floor)."""
        held = rows.groupBy("pack").agg(F.collect_list(F.struct("id", "v", "number", "floor")).alias("queries"))  # about QUERIES
        pairs = held.withColumn("block", F.explode(where)).join(index, "block")
        return save(pairs.select("n", "width", "ids", "values", "posting", "segments", "queries").mapInArrow(run, "query_id long, _query long, _id long, score long"), "topk-found")

    home = F.pmod(F.col("pack"), F.lit(blocks)).cast("int")
    found = meet(asked.withColumn("floor", F.lit(None).cast("long")), F.array(home))
    if blocks > 1:
        least = found.groupBy("query_id", "_query").agg(F.count("*").alias("_n"), F.min("score").alias("_least")).filter(F.col("_n") == k)
        least = asked.join(least, (F.col("id") == F.col("query_id")) & (F.col("number") == F.col("_query")), "left")
        others = F.array_remove(F.sequence(F.lit(0), F.lit(blocks - 1)), home)
        found = found.unionByName(meet(least.select("id", "v", "number", "pack", F.col("_least").alias("floor")), others))
    rank = F.row_number().over(W.partitionBy("query_id", "_query").orderBy(F.col("score").desc(), F.col("_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("_id").alias(id_col), "score")


def op8_topk(spark, sf_dir: str) -> DataFrame:
    """Ten best rows for every row whose id is divisible by 100."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(rows, rows.filter(F.col("vec_id") % 100 == 0))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.e, r.e) AS BIGINT) AS score
  FROM v q JOIN v r ON r.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
