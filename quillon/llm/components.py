"""Connected components of a graph of any size, by contraction.

Every task joins the edges it reads into trees of its own, and each node then has one root per task that
saw it.  Nodes whose roots differ tie these roots: they are the edges of a smaller graph, in which only
roots are left, and the step is repeated on it.  Nodes with very many edges have one row per task after
the first step, so no group is large; the graph gets smaller by a constant part a round at least where
nodes are numbered at random, and at once where a task sees much of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, save

#: Edges that a task joins at once.
CHUNK = 1 << 20


def forest(links: np.ndarray) -> np.ndarray:
    """As few of the links as connect the same nodes: each node with the smallest of its tree."""
    node, root = roots(links)
    return np.stack([node, root], 1)[node != root]


def roots(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links, ascending, and the smallest node of each one's tree."""
    node, link = np.unique(links, return_inverse=True)
    link = link.reshape(-1, 2)
    root = np.arange(len(node))
    while len(link):
        low, high = root[link].min(axis=1), root[link].max(axis=1)
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        link = link[root[link[:, 0]] != root[link[:, 1]]]
    return node, node[root]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of the trees that a task's edges make."""
    held, n = [], 0

    def close() -> Iterator[pa.RecordBatch]:
        node, root = roots(np.concatenate(held))
        for i in range(0, len(node), 65_536):
            yield pa.RecordBatch.from_arrays([pa.array(node[i : i + 65_536]), pa.array(root[i : i + 65_536])], ["node", "root"])

    for b in batches:
        held.append(np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1))
        n += b.num_rows
        if n >= CHUNK:
            yield from close()
            held, n = [], 0
    if n:
        yield from close()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable.

    Loops and repeated edges are fine; nodes without edges don't appear.  The driver sees one count a
    round.
    """
    edges = save(edges.select("a", "b").filter("a <> b"), "edges")
    levels = []
    while edges.count():
        trees = edges.mapInArrow(_trees, "node long, root long")
        level = save(trees.groupBy("node").agg(F.min("root").alias("component"), F.collect_set("root").alias("roots")), "trees")
        levels.append(level)
        drop(edges)
        edges = save(level.select(F.explode("roots").alias("a"), F.col("component").alias("b")).filter("a <> b"), "edges")
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = levels.pop().select("node", "component")
    while levels:  # a root's component is its nodes' component
        above = out.select(F.col("node").alias("_root"), F.col("component").alias("_above"))
        level = levels.pop().select("node", "component")
        out = level.join(above, F.col("component") == F.col("_root"), "left").select("node", F.coalesce("_above", "component").alias("component"))
    return out
