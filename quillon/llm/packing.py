"""Best-fit packing by hierarchical residual packing.

Every task cuts and packs its own documents by best fit and closes the bins that are nearly full.
Bins with room left become items: a tree of ever fewer nodes packs them again, each node closing
what it fills.  The tree ends above ``FAN_IN`` nodes, so that no single task sees all open bins; what
it leaves is packed by the histogram of its sizes, which has at most ``capacity`` rows whatever the
input; every bin then finds its place by its rank within its size.  No task ever holds more than
``CHUNK`` items.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import save, tidy
from .tokens import RANKS, encoder

#: Items that one best-fit run holds.
CHUNK = 65_536
#: Nodes of the tree that meet in one node above.
FAN_IN = 8
#: A bin with at most 1/SLACK of its room left is closed.
SLACK = 256


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit in descending order of size: (bin, offset) of each item and each bin's used room.

    Bins stand in lists by room left; a bit mask of the lists that aren't empty gives the tightest
    one that an item fits in.
    """
    order = np.argsort(-sizes, kind="stable")
    where, offset, used = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in order.tolist():
        s = int(sizes[i])
        fits = mask >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(used)
            used.append(0)
        where[i], offset[i] = b, used[b]
        used[b] += s
        by_room[room - s].append(b)
        mask |= 1 << (room - s)
    return where, offset, np.array(used, np.int64)


def pack_counts(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit of ``counts`` items by size: (size, first rank, end rank, first bin, offset) slots.

    Items of a size are told apart by rank; the item of rank r in a slot goes to bin
    ``first bin + r - first rank``.  Bins with equal contents are handled together, so the work
    follows the number of sizes and not the number of items.
    """
    slots, bins = [], 0
    groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (first bin, number)
    mask = 0

    def put(room: int, first: int, n: int) -> None:
        nonlocal mask
        groups[room].append((first, n))
        mask |= 1 << room

    for s in sorted(counts, reverse=True):
        rank, left = 0, counts[s]
        while left:
            fits = mask >> s
            if fits:
                room = s + (fits & -fits).bit_length() - 1
                first, n = groups[room].pop()
                if not groups[room]:
                    mask &= ~(1 << room)
                m = min(n, left)
                if m < n:
                    put(room, first + m, n - m)
            else:  # new bins, with as many of the size as fit in one
                each = max(1, min(capacity // s, left))
                first, m, room = bins, max(1, left // each), capacity
                bins += m
                for k in range(each - 1):
                    slots.append((s, rank, rank + m, first, capacity - room))
                    rank, left, room = rank + m, left - m, room - s
            slots.append((s, rank, rank + m, first, capacity - room))
            rank, left = rank + m, left - m
            put(room - s, first, m)
    return slots


PIECES = "piece int, start long, length long, ids_crc32 long, node long, bin long, at long, used long"


def cut_and_pack(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, ranks: str, special: bool = False) -> DataFrame:
    """Encode each document, cut it, and pack the pieces of each task.

    A document longer than ``capacity`` is cut into pieces of ``capacity``; the first takes the rest.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()
    names = ["_id", *[x.split()[0] for x in PIECES.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, node = encoder(ranks, special), TaskContext.get().partitionId()
        bins, held, ids = 0, [], []

        def pack() -> pa.RecordBatch:
            nonlocal bins, held, ids
            data = np.array(held, np.int64).reshape(-1, 4)
            where, at, used = best_fit(data[:, 2], capacity)
            columns = [*data.T, np.full(len(data), node), where + bins + (node << 32), at, used[where] if len(used) else where]
            bins += len(used)
            out = [pa.concat_arrays(ids), pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            held, ids = [], []
            return pa.RecordBatch.from_arrays(out, names)

        for b in batches:
            lengths = []
            for text in b.column("_text").to_pylist():
                got = array("I", encode(text))
                got.append(end_id)
                n = len(got)
                lengths.append(-(-n // capacity))
                start = 0
                for piece in range(lengths[-1]):
                    length = n - capacity * (lengths[-1] - 1) if piece == 0 else capacity
                    held.append((piece, start, length, zlib.crc32(got[start : start + length])))
                    start += length
            if lengths:
                ids.append(b.column(0).take(pa.array(np.repeat(np.arange(len(lengths)), lengths))))
            if len(held) >= CHUNK:
                yield pack()
        if held:
            yield pack()

    return rows.mapInArrow(tidy(run), f"_id {kind}, {PIECES}").withColumnRenamed("_id", id_col)


def pack_nodes(bins: DataFrame, nodes: int, level: int, capacity: int) -> DataFrame:
    """One level of the tree: (bin, up, off, used) for bins as items of ``nodes`` nodes."""
    dealt = bins.repartition(nodes, F.expr(f"node div {FAN_IN**level}")).sortWithinPartitions("bin")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, n = TaskContext.get().partitionId(), 0, [], 0

        def pack() -> pa.RecordBatch:
            nonlocal made, held, n
            t = pa.Table.from_batches(held)
            where, off, used = best_fit(t.column("used").to_numpy(), capacity)
            up = where + made + (level << 56) + (task << 32)
            made, held, n = made + len(used), [], 0
            return pa.RecordBatch.from_arrays(
                [t.column("bin").combine_chunks(), t.column("node").combine_chunks(), pa.array(up), pa.array(off), pa.array(used[where])], ["bin", "node", "up", "off", "used"]
            )

        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= CHUNK:
                yield pack()
        if n:
            yield pack()

    return dealt.select("bin", "node", "used").mapInArrow(tidy(run), "bin long, node long, up long, off long, used long")


def pack_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, ranks: str = RANKS, special: bool = False
) -> DataFrame:
    """Pack every row of ``docs`` into sequences of at most ``capacity`` tokens.

    Returns one row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.  Each text
    is followed by ``end_id``; null and empty texts have that id alone.  ``special`` says whether
    ``<|endoftext|>`` in a text is the token of that name.  Repeated rows and repeated or
    null ids each keep their pieces, since no step joins on the id; an empty table gives no rows and
    other columns aren't looked at; texts of any length are encoded whole and cut.  Sequence ids are unique, not dense.
    """
    spark = docs.sparkSession
    pieces = save(cut_and_pack(docs, id_col, text_col, capacity, end_id, ranks, special), "pack-pieces")
    room = capacity - capacity // SLACK
    # a bin's first piece stands for it
    open_bins = pieces.filter((F.col("at") == 0) & (F.col("used") < room)).select("bin", "node", "used")
    place = open_bins.select("bin", F.col("bin").alias("top"), F.lit(0).cast("long").alias("base"))
    nodes = (pieces.agg(F.max("node")).first()[0] or 0) + 1
    before, level = open_bins.count(), 0
    while before and (nodes > FAN_IN or not level):  # few nodes merge in pairs, once; one node's bins meet again
        level, nodes = level + 1, -(-nodes // (FAN_IN if nodes > FAN_IN else 2))
        made = save(pack_nodes(open_bins, nodes, level, capacity), f"pack-level{level}")
        place = save(
            place.join(made.select(F.col("bin").alias("top"), "up", "off"), "top", "left").select(
                "bin", F.coalesce("up", "top").alias("top"), (F.col("base") + F.coalesce("off", F.lit(0))).alias("base")
            ),
            f"pack-place{level}",
        )
        open_bins = made.filter((F.col("off") == 0) & (F.col("used") < room)).select(F.col("up").alias("bin"), "node", "used")
        now = open_bins.count()
        if now > 0.98 * before:
            break  # the sizes left don't fit together; the histogram sees them all at once
        before = now
    place = save(root(open_bins, place, capacity), "pack-place")
    done = pieces.join(place.withColumnRenamed("bin", "_bin"), F.col("bin") == F.col("_bin"), "left")
    return done.select(
        id_col, "piece", "start", "length", "ids_crc32", F.coalesce("top", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("base", F.lit(0))).alias("offset")
    )


def root(open_bins: DataFrame, place: DataFrame, capacity: int) -> DataFrame:
    """Pack what the tree leaves by the histogram of its sizes."""
    spark = open_bins.sparkSession
    counts = {r["used"]: r["n"] for r in open_bins.groupBy("used").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    if not counts:
        return place
    slots = spark.createDataFrame(pack_counts(counts, capacity), "size long, lo long, hi long, first long, off long")
    # rank within a size without sorting a whole size in one task: by node, then within the node
    per = open_bins.groupBy("used", "node").agg(F.count("*").alias("n"))
    before = per.select(
        "used", "node", F.coalesce(F.sum("n").over(W.partitionBy("used").orderBy("node").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    ranked = open_bins.join(before, ["used", "node"]).withColumn("rank", F.col("before") + F.row_number().over(W.partitionBy("used", "node").orderBy("bin")) - 1)
    ranked = ranked.join(slots, (F.col("used") == F.col("size")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    ends = ranked.select(F.col("bin").alias("top"), (F.lit(1 << 62) + F.col("first") + F.col("rank") - F.col("lo")).alias("up"), "off")
    return place.join(ends, "top", "left").select("bin", F.coalesce("up", "top").alias("top"), (F.col("base") + F.coalesce("off", F.lit(0))).alias("base"))


def packed_ids(docs: DataFrame, packed: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, ranks: str = RANKS, special: bool = False) -> DataFrame:
    """(sequence_id, ids): the sequences themselves, for tables whose ids are unique."""
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    per_doc = packed.groupBy(id_col).agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("_cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, special)
        for b in batches:
            out = []
            for text, cuts in zip(b.column("_text").to_pylist(), b.column("_cuts").to_pylist()):
                got = [*encode(text), end_id]
                out += [(c["sequence_id"], c["offset"], got[c["start"] : c["start"] + c["length"]]) for c in cuts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32())))], ["sequence_id", "offset", "ids"]
            )

    parts = rows.join(per_doc, id_col).select("_text", "_cuts").mapInArrow(tidy(run), "sequence_id long, offset long, ids array<int>")
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2,048 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), special=True)
