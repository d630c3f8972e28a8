"""Hard negatives by exact integer scores, several candidates in one product.

Components are whole numbers.  The components of several candidates in one dimension are biased, so that
none is negative, and laid into separated fields of one wide integer (Kronecker's substitution).  One
multiplication with an anchor's biased component multiplies all of them, sums over the dimensions stay
within their fields, and the fields are unpacked to exact scores.  The wide integers have 53 bits and are held
in doubles where that makes room for a field at least, so that a matrix product multiplies and sums them
without rounding; larger numbers go into Python's integers, with as many fields.

Packs of anchors meet blocks of candidates twice: first for an anchor's positives, then for the negatives
below each of them.  Tasks hand on a few rows per anchor or positive, and windows merge these.
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

#: Rows of a block of candidates, anchors of a pack, anchors whose scores are held at once.
ROWS, ANCHORS, SLICE = 16_384, 512, 32
#: Bits of the wide integers that doubles hold exactly, and fields of those that Python holds.
BITS, WIDE_FIELDS = 53, 64
#: Scores are returned as 64-bit numbers.
LONG = (1 << 63) - 1


def scaled(v: Column, scale: int) -> Column:
    return F.transform(v, lambda x: x.cast("double") * float(scale))


def usable(v: Column) -> Column:
    """Vectors that take part: not null, and without null or non-finite components."""
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def floors(v: Column) -> Column:
    """Whole numbers, as doubles; doubles from 2^53 on are whole anyway."""
    return F.transform(v, lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x))


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list column, ended by zeros."""
    n = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), max(width, int(n.max(initial=0)))))
    out[np.arange(out.shape[1]) < n[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Packed:
    """Candidates with their components in fields; ``scores`` multiplies anchors with all of them."""

    def __init__(self, rows: np.ndarray, anchor_low: float, anchor_high: float):
        """``rows`` has whole numbers; anchors have components from ``anchor_low`` to ``anchor_high``."""
        self.n, self.width = rows.shape
        self.bias, self.anchor_bias = -int(rows.min(initial=0)), -int(min(anchor_low, 0))
        most = self.width * max(1, int(rows.max(initial=0)) + self.bias) * max(1, int(max(anchor_high, 0)) + self.anchor_bias)
        self.field = max(1, most.bit_length())
        self.in_doubles = self.field <= BITS
        self.fields = BITS // self.field if self.in_doubles else WIDE_FIELDS
        kind = np.float64 if self.in_doubles else object
        whole = rows if self.in_doubles else np.vectorize(int, [object])(rows) if rows.size else rows.astype(object)
        biased = np.zeros((-(-self.n // self.fields) * self.fields, self.width), kind)
        biased[: self.n] = whole + self.bias
        self.sums = whole.sum(axis=1)
        # field f of integer g is candidate f * groups + g
        groups = len(biased) // self.fields
        self.wide = np.zeros((groups, self.width), kind)
        for f in range(self.fields):
            shift = float(1 << f * self.field) if self.in_doubles else 1 << f * self.field
            self.wide += biased[f * groups : (f + 1) * groups] * shift

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products, a row per anchor, as 64-bit numbers; what is beyond them is the last of them."""
        if self.in_doubles:
            left = ((anchors + self.anchor_bias) @ self.wide.T).astype(np.int64)
            sums = self.sums.astype(np.int64)
            own = anchors.sum(axis=1).astype(np.int64)
        else:
            whole = np.vectorize(int, [object])(anchors) if anchors.size else anchors.astype(object)
            left, sums, own = (whole + self.anchor_bias).dot(self.wide.T), self.sums, whole.sum(axis=1)
        mask, parts = (1 << self.field) - 1, []
        for _ in range(self.fields):
            parts.append(left & mask)
            left = left >> self.field
        unpacked = np.concatenate(parts, axis=1)[:, : self.n]
        out = unpacked - (self.anchor_bias * sums[None, :] + self.bias * own[:, None] + self.width * self.bias * self.anchor_bias)
        return out if self.in_doubles else np.clip(out, -LONG, LONG).astype(np.int64)


def _blocks(rows: DataFrame) -> DataFrame:
    """(key, n, width, ids, labels, values): blocks of up to ROWS rows, by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key = [], 0, TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            nonlocal held, size, key
            t = pa.Table.from_batches(held).combine_chunks()
            ids, labels = (t.column(c).to_numpy() for c in ("id", "label"))
            m = matrix(t.column("v").combine_chunks())
            order = np.argsort(ids, kind="stable")
            cells = [key, len(ids), m.shape[1], ids[order].tobytes(), labels[order].tobytes(), m[order].tobytes()]
            held, size, key = [], 0, key + 1
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(cells, [*[pa.int64()] * 3, *[pa.binary()] * 3])], ["key", "n", "width", "ids", "labels", "values"])

        for b in batches:
            while b.num_rows:
                part = b.slice(0, ROWS - size)
                held.append(part)
                size += part.num_rows
                b = b.slice(part.num_rows)
                if size == ROWS:
                    yield flush()
        if size:
            yield flush()

    return rows.select("id", "label", "v").mapInArrow(run, "key long, n long, width long, ids binary, labels binary, values binary")


def _meetings(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, Packed, pa.StructArray, np.ndarray]]:
    """(ids, labels, packed candidates, anchors, their components) of each row of block and pack."""
    cell = lambda c, r: b.column(c)[r].as_py()
    for r in range(b.num_rows):
        n, width = cell("n", r), cell("width", r)
        ids, labels = np.frombuffer(cell("ids", r), np.int64), np.frombuffer(cell("labels", r), np.int64)
        m = np.frombuffer(cell("values", r), np.float64).reshape(n, width)
        anchors = b.column("anchors")[r].values
        a = matrix(anchors.field("v"), width)
        m = np.pad(m, ((0, 0), (0, a.shape[1] - width)))
        yield ids, labels, Packed(m, float(a.min(initial=0)), float(a.max(initial=0))), anchors, a


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by place."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        rows = np.flatnonzero(scores >= floor)
    else:
        rows = np.arange(len(scores))
    return rows[np.argsort(-scores[rows], kind="stable")][:k]


def _batch(columns: list[list], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, *, positives: int = 5, negatives: int = 5, low: tuple[int, int] = (80, 100), scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components are floor(scale * x), scores integer inner products; higher come first, ties by smaller id.
    An anchor's positives are its best ``positives`` other rows with its label.  For each of them the first
    ``negatives`` rows with other labels come whose score is at most the positive's and at least low[0] / low[1] of it.

    Rows with a null id or label, a null vector, or components that are null or, times ``scale``, not finite take
    no part on either side; shorter vectors end in zeros.  Rows with an anchor's id are no other rows; repeated rows are rows, each
    with a place of its own, and repeated anchors count once; anchors without positives, positives without negatives
    and empty tables give no rows.  Scores beyond 64 bits count as the nearest 64-bit
    number.  Labels are whole numbers, of which one may have any share of the rows: blocks don't depend on them.
    """
    plain = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), scaled(F.col(vector_col), scale).alias("v"))
    pick = lambda df: plain(df).filter(usable(F.col("v")) & F.col("id").isNotNull() & F.col("label").isNotNull()).withColumn("v", floors(F.col("v")))
    blocks = save(_blocks(pick(rows)), "negatives-blocks")
    number = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("_key")) - 1  # a row per block
    number = blocks.select(F.col("key").alias("_key")).withColumn("block", number)
    blocks, count = blocks.join(number, F.col("key") == F.col("_key")).drop("key", "_key"), blocks.count()
    asked = save(pick(anchors).distinct().withColumn("anchor", F.xxhash64("id", "label", "v")), "negatives-anchors")
    packs = max(1, -(-asked.count() // ANCHORS))
    asked = asked.withColumn("pack", F.pmod("anchor", F.lit(packs)).cast("int"))

    def meet(held: DataFrame, run, schema: str) -> DataFrame:
        """``run`` over each pack of ``held`` with each block."""
        packed = held.groupBy("pack").agg(F.collect_list(F.struct(*[c for c in held.columns if c != "pack"])).alias("anchors"))  # about ANCHORS
        pairs = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, count - 1))))).join(blocks, "block")
        return pairs.select("n", "width", "ids", "labels", "values", "anchors").mapInArrow(run, schema)

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, labels, packed, found, a in _meetings(b):
                anchor, own, label = (found.field(c).to_numpy(zero_copy_only=False) for c in ("anchor", "id", "label"))
                out: list[list] = [[], [], [], []]
                for i in range(0, len(a), SLICE):
                    for j, scores in enumerate(packed.scores(a[i : i + SLICE]), i):
                        others = np.flatnonzero((labels == label[j]) & (ids != own[j]))
                        top = others[_best(scores[others], positives)]
                        for c, x in zip(out, ([anchor[j]] * len(top), [own[j]] * len(top), ids[top], scores[top])):
                            c.extend(x)
                yield _batch(out, ["anchor", "anchor_id", "positive_id", "positive_score"])

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, labels, packed, found, a in _meetings(b):
                anchor, own, label = (found.field(c).to_numpy(zero_copy_only=False) for c in ("anchor", "id", "label"))
                out: list[list] = [[], [], [], [], []]
                for i in range(0, len(a), SLICE):
                    for j, scores in enumerate(packed.scores(a[i : i + SLICE]), i):
                        wanted = found.field("scores")[j].as_py()
                        least = [-(-low[0] * score // low[1]) for score in wanted]  # rounded up
                        others = np.flatnonzero((labels != label[j]) & (ids != own[j]) & (scores <= max(wanted)) & (scores >= min(least)))
                        order = others[np.argsort(-scores[others], kind="stable")]
                        falling = -scores[order]
                        for rank, score, floor in zip(found.field("ranks")[j].as_py(), wanted, least):
                            begin, end = np.searchsorted(falling, -score), np.searchsorted(falling, -floor, "right")
                            top = order[begin : min(end, begin + negatives)]
                            for c, x in zip(out, ([anchor[j]] * len(top), [rank] * len(top), [score] * len(top), ids[top], scores[top])):
                                c.extend(x)
                yield _batch(out, ["_anchor", "_rank", "_score", "negative_id", "negative_score"])

    first = meet(asked.select("pack", "anchor", "id", "label", "v"), same, "anchor long, anchor_id long, positive_id long, positive_score long")
    best = F.row_number().over(W.partitionBy("anchor").orderBy(F.col("positive_score").desc(), "positive_id"))
    found = save(first.withColumn("place", best).filter(F.col("place") <= positives), "negatives-positives")
    lists = found.groupBy("anchor").agg(F.collect_list(F.col("place").cast("long")).alias("ranks"), F.collect_list("positive_score").alias("scores"))
    second = meet(asked.join(lists, "anchor").select("pack", "anchor", "id", "label", "v", "ranks", "scores"), below, "_anchor long, _rank long, _score long, negative_id long, negative_score long")
    order = F.row_number().over(W.partitionBy("_anchor", "_rank").orderBy(F.col("negative_score").desc(), "negative_id"))
    second = second.withColumn("rank", order).filter(F.col("rank") <= negatives)
    joined = found.join(second, (F.col("anchor") == F.col("_anchor")) & (F.col("place") == F.col("_rank")))
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose id is divisible by 100; ids divisible by 7 have the next label."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, rows.filter(F.col("vec_id") % 100 == 0))


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, r.vec_id AS r, a.label = r.label AS same, CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, r, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, r) <= 5),
n AS (
  SELECT p.a AS anchor_id, p.r AS positive_id, row_number() OVER (PARTITION BY p.a, p.r ORDER BY s.score DESC, s.r) AS rank, s.r AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.a = s.a WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
