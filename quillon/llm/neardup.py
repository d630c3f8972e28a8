"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors link when their squared distance is at most ``2 - 2 * cosine``.  The vectors are
rotated (random signs and a Hadamard transform, so that no component holds most of the distance) and
split into blocks of components.  Two linking vectors must be within a block's part of the squared
distance, in proportion to its components, in one block at least.  So every block is range-joined by
itself: a grid over its first components deals the rows, a row goes to each cell that its range
reaches, and within a cell tiles of rows are compared in the block's components.  Pairs within the
range are checked exactly on the whole vectors, in double precision.  How fine the grid is follows from
the number of rows and from what a sample of them shows: finer grids compare fewer pairs and copy rows
more often.

A pair that several blocks find counts in the first of them only, which each task can tell by itself,
so no list of pairs is made: tasks hand on counts and a spanning forest of links per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, save
from .components import components, forest

#: Blocks that the components are split into.
BLOCKS = 4
#: Most rows on one side of a task.
SIDE = 16_384
#: Rows of the sample that the grid's cost is estimated from, and the least number of its components; it
#: has two cells for each.
SAMPLE, BITS_LEAST = 4096, 2
#: Seconds, about, for a copy of a row and for a pair of rows compared; only their ratio matters.
COPY, PAIR = 4e-6, 4e-9
SEED = 7_919
#: Distances are compared with this much room for rounding; what is let through is checked exactly.
ROOM = 1e-4


def usable(v: Column) -> Column:
    x = lambda e: e.cast("double")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(x(e)) & (F.abs(x(e)) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda e: x(e) != 0)


def padded(width: int) -> int:
    """Next power of two that the blocks divide."""
    n = BLOCKS
    while n < width:
        n *= 2
    return n


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that no square is too large or too small."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotate(unit: np.ndarray) -> np.ndarray:
    """Random signs and a Hadamard transform: sums and differences, in an order that depends on no
    other row, so every task gets the same numbers for a vector."""
    n, width = unit.shape
    x = unit * (np.random.default_rng(SEED).integers(0, 2, width) * 2.0 - 1)
    half = 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def reach(x: np.ndarray, bits: int, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, cell, at home) of a block's rows: the cell by signs, and later cells within the budget."""
    home = (x[:, :bits] >= 0) @ (1 << np.arange(bits)) if bits else np.zeros(len(x), np.int64)
    yield np.arange(len(x)), home, True
    cost = x[:, :bits] ** 2
    for flip in range(1, 1 << bits):
        on = np.array([flip >> b & 1 for b in range(bits)], bool)
        cell = home ^ flip
        rows = np.flatnonzero((cost[:, on].sum(axis=1) <= budget) & (cell > home))
        if len(rows):
            yield rows, cell[rows], False


def grid_share(part: np.ndarray, bits: int, budget: float) -> tuple[float, float]:
    """(copies of a row, share of all pairs that meet in a cell) of a grid over ``bits`` components."""
    home, guests = np.zeros(1 << bits), np.zeros(1 << bits)
    for _, cell, at_home in reach(part, bits, budget):
        count = np.bincount(cell, minlength=1 << bits)
        home, guests = (home + count, guests) if at_home else (home, guests + count)
    n = len(part)
    return (home.sum() + guests.sum()) / n, float((home * (home - 1) / 2 + home * guests).sum()) / max(1, n * (n - 1) / 2)


def grid_bits(sample: np.ndarray, n: int, budget: float) -> int:
    """Components of the grid for which copies and pairs of ``n`` rows cost least."""
    part = np.split(rotate(unit_rows(sample)), BLOCKS, axis=1)[0] if len(sample) else np.zeros((0, 1))
    best, bits = (np.inf, 0), 0
    for bits in range(min(BITS_LEAST, part.shape[1]), part.shape[1] + 1):
        copies, share = grid_share(part, bits, budget) if len(part) else (1, 1)
        cost = COPY * n * copies + PAIR * n * (n - 1) / 2 * share
        best = min(best, (cost, bits))
        if cost > 2 * best[0] or not len(part):
            break
    return best[1]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    n = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width))
    out[np.arange(width) < n[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def deal_counts(rows: DataFrame, width: int, bits: int, budget: float) -> DataFrame:
    """(block, cell, at_home, guests): rows of each cell, counted by task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BLOCKS, 1 << bits), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                x = rotate(unit_rows(matrix(whole.column("vector").slice(at, 2048), width)))
                for k, part in enumerate(np.split(x, BLOCKS, axis=1)):
                    for _, cell, home in reach(part, bits, budget):
                        total[int(not home), k] += np.bincount(cell, minlength=1 << bits)
        block, cell = np.nonzero(total.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array(cell.astype(np.int32)), *[pa.array(t[block, cell]) for t in total]], ["block", "cell", "at_home", "guests"])

    found = rows.select("vector").mapInArrow(run, "block int, cell int, at_home long, guests long")
    return found.groupBy(F.col("block").alias("_block"), F.col("cell").alias("_cell")).agg(F.sum("at_home").alias("_h"), F.sum("guests").alias("_g"))


def deal(rows: DataFrame, width: int, bits: int, budget: float) -> DataFrame:
    """(block, cell, home, node, weight, vector) for every cell a row goes to."""
    kind = rows.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                x = rotate(unit_rows(matrix(b.column("vector"), width)))
                for k, part in enumerate(np.split(x, BLOCKS, axis=1)):
                    for who, cell, home in reach(part, bits, budget):
                        take = b.take(pa.array(who))
                        n = len(who)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, k, np.int32)), pa.array(cell.astype(np.int32)), pa.array(np.full(n, home)), *take.columns], ["block", "cell", "home", "node", "weight", "vector"]
                        )

    return rows.select("node", "weight", "vector").mapInArrow(run, f"block int, cell int, home boolean, node long, weight long, vector {kind}")


def compare(x: np.ndarray, y: np.ndarray, block: int, cosine: float, budget: float, same: bool) -> Iterator[np.ndarray]:
    """Links (i, j) of rows of x with rows of y (with ``same``, of x with later rows of itself)."""
    ux, uy = unit_rows(x), unit_rows(y)
    rx, ry = rotate(ux), rotate(uy)
    size = x.shape[1] // BLOCKS
    cut = slice(block * size, (block + 1) * size)
    bx, by = rx[:, cut].astype(np.float32), ry[:, cut].astype(np.float32)
    ny = (by * by).sum(axis=1)
    step = max(1, (1 << 21) // max(1, len(y)))
    for lo in range(0, len(x), step):
        t = bx[lo : lo + step]
        near = ny[None, :] - 2 * (t @ by.T) <= np.float32(budget * (1 + ROOM) + 1e-5) - (t * t).sum(axis=1)[:, None]
        i, j = np.nonzero(near)
        i += lo
        if same:
            i, j = i[j > i], j[j > i]
        for at in range(0, len(i), 1 << 15):
            p, q = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
            d = ((rx[p] - ry[q]) ** 2).reshape(len(p), BLOCKS, size).sum(axis=2)
            within = d <= budget * (1 + ROOM)
            first = within[:, block] & ~within[:, :block].any(axis=1)
            p, q = p[first], q[first]
            link = (ux[p] * uy[q]).sum(axis=1) >= cosine
            yield np.stack([p[link], q[link]], 1)


def links(nodes: DataFrame, width: int, bits: int, cosine: float, budget: float) -> DataFrame:
    """(node, links, tied): what one task step adds to a row's links, and a node of its tree."""
    dealt = deal(nodes, width, bits, budget * (1 + ROOM))
    sides = lambda n: F.ceil(F.col(n) / SIDE).cast("int")
    per = deal_counts(nodes, width, bits, budget * (1 + ROOM)).select("_block", "_cell", sides("_h").alias("_at_home"), sides("_g").alias("_guests"))
    per = save(per, "neardup-sides")  # a row per cell
    rows = dealt.join(per, (F.col("block") == F.col("_block")) & (F.col("cell") == F.col("_cell")) & (F.col("_at_home") > 0))
    spread = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    rows = rows.withColumn("side", F.when(F.col("home"), spread(F.col("_at_home"))).otherwise(spread(F.col("_guests"))))
    span = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    # a step has two sides at home (lo <= hi), or guests (lo < 0) and a side at home
    at_home = F.concat(
        F.transform(span(F.col("_at_home")), lambda o: F.struct(F.least("side", o).alias("lo"), F.greatest("side", o).alias("hi"))),
        F.transform(span(F.col("_guests")), lambda g: F.struct((-1 - g).alias("lo"), F.col("side").alias("hi"))),
    )
    guest = F.transform(span(F.col("_at_home")), lambda o: F.struct((-1 - F.col("side")).alias("lo"), o.alias("hi")))
    steps = rows.withColumn("_step", F.explode(F.when(F.col("home"), at_home).otherwise(guest)))
    steps = steps.select("block", "cell", F.col("_step.lo").alias("lo"), F.col("_step.hi").alias("hi"), F.when(F.col("home"), F.col("side")).otherwise(-1 - F.col("side")).alias("side"), "node", "weight", "vector")
    steps = steps.repartition("block", "cell", "lo", "hi").sortWithinPartitions("block", "cell", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def step() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            side, node, weight = (t.column(c).to_numpy() for c in ("side", "node", "weight"))
            x = matrix(t.column("vector").combine_chunks(), width)
            block, _, lo, hi = now
            left, right = np.flatnonzero(side == lo), np.flatnonzero(side == hi)
            total, trees = np.zeros(len(node), np.int64), []
            for found in compare(x[left], x[right], block, cosine, budget, lo == hi):
                if len(found):
                    a, b = left[found[:, 0]], right[found[:, 1]]
                    np.add.at(total, a, weight[b])
                    np.add.at(total, b, weight[a])
                    trees.append(forest(np.stack([a, b], 1)))
                    if len(trees) > 32:
                        trees = [forest(np.concatenate(trees))]
            if trees:
                tree = forest(np.concatenate(trees))
                tied = np.arange(len(node))
                tied[tree[:, 0]] = tree[:, 1]
                who = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(node[who]), pa.array(total[who]), pa.array(node[tied[who]])], ["node", "links", "tied"])

        now, held = None, []
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy() for c in ("block", "cell", "lo", "hi")], 1)
            cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
            for i, j in zip(cuts[:-1], cuts[1:]):
                at = tuple(int(v) for v in keys[i])
                if now != at:
                    if held:
                        yield from step()
                    now, held = at, []
                held.append(b.slice(i, j - i))
        if held:
            yield from step()

    return steps.mapInArrow(run, "node long, links long, tied long")


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, bits: int | None = None) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``vectors``.

    Rows link when the cosine of their vectors is at least ``cosine`` (above 0), in double precision;
    n_links counts the other rows linked, component_id is the smallest id reachable.  Null and zero
    vectors and vectors with null or non-finite components link with nothing.  Equal vectors are
    compared once and count as often as they occur; vectors of different widths are compared as if
    the shorter one ended in zeros.  Rows with a null id are kept apart from components' ids but
    count as links.  An empty table gives no rows; other columns aren't looked at.
    """
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"))
    ok = rows.filter(usable(F.col("_vector")))
    seed = 0
    while True:  # different vectors get different names; a clash, which hardly happens, asks for another seed
        name = F.xxhash64("_vector", F.lit(seed))
        nodes = ok.groupBy("_vector").agg(F.count("*").alias("weight"), F.min("_id").alias("least")).select(name.alias("node"), F.col("_vector").alias("vector"), "weight", "least")
        nodes = save(nodes, "neardup-nodes")
        if nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            break
        drop(nodes)
        seed += 1
    n, longest = nodes.agg(F.count("*"), F.max(F.size("vector"))).first()
    width, budget = padded(longest or 1), (2 - 2 * cosine) / BLOCKS
    if bits is None:
        some = nodes.orderBy("node").limit(SAMPLE).select("vector").toPandas()["vector"]  # hashes: a random sample
        sample = np.zeros((len(some), width))
        for i, v in enumerate(some):
            sample[i, : len(v)] = v
        bits = grid_bits(sample, n, budget * (1 + ROOM))
    found = save(links(nodes, width, min(bits, width // BLOCKS), cosine, budget), "neardup-links")
    tied = save(components(found.select(F.col("node").alias("a"), F.col("tied").alias("b"))), "neardup-components")
    total = found.groupBy(F.col("node").alias("_node")).agg(F.sum("links").alias("others"))
    whole = nodes.join(total, F.col("node") == F.col("_node"), "left").drop("_node").join(tied.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    whole = whole.select("node", "least", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    least = whole.groupBy(F.col("component").alias("_component")).agg(F.min("least").alias("component_id"))
    whole = save(whole.join(least, F.col("component") == F.col("_component")).select("node", "n_links", "component_id"), "neardup-classes")
    done = rows.withColumn("_node", F.when(usable(F.col("_vector")), name)).drop("_vector").join(whole, F.col("_node") == F.col("node"), "left")
    component = F.coalesce("component_id", "_id")
    return done.select(F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("_id") == component).alias("kept"))


def op2_neardup(spark, sf_dir: str) -> DataFrame:
    """Classes of embeddings with a cosine of 0.9 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
