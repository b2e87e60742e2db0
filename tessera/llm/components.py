"""Connected components of an edge table.

Up to LOCAL edges one task reads and solves, however they are dealt out: a
bounded amount of work, where rounds over the cluster cost more than what they
share out. Larger tables go by alternating stars.

Each round links every node's larger neighbours, then its smaller ones, to its
least neighbour (large star and small star), until the edges are stars about
the least node of each component. A round aggregates and joins on nodes; the
edges of a round are a written table, so that nothing is recomputed. A hub is
aggregated before the shuffle; its least neighbour is written before the join,
so that the join reads two tables and Spark can split the hub.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.workspace import materialize, release

#: Edges that one task solves, 8 MB of them.
LOCAL = 500_000


def solve(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes in order and the least node of each one's component: roots hang on to smaller roots until no edge is open."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(u):
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        is_open = low < high
        u, v = u[is_open], v[is_open]
        np.minimum.at(root, high[is_open], low[is_open])
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def _in_a_task(edges: DataFrame) -> DataFrame:
    """(node, root) of a bounded table of edges (a, b)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches if len(x)]
        if got:
            node, root = solve(*(np.concatenate(x) for x in zip(*got)))
            for lo in range(0, len(node), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(node[lo : lo + 100_000]), pa.array(root[lo : lo + 100_000])], ["node", "root"])

    return materialize(edges.coalesce(1).mapInArrow(task, "node long, root long"), "roots")


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("v", "u"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """(u, v) with u > v: nodes linked to the least node next to them."""
    near = _both(edges) if large else edges
    least = materialize(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w"), "least")
    met = near.join(least, near.u == least.w)
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("w", "m"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60, local: int | None = None) -> DataFrame:
    """(node, root) of every node of an edge (a, b), with the least node as root; ``edges`` is a written table."""
    edges = edges.select("a", "b").where("a <> b")
    if edges.count() <= (LOCAL if local is None else local):
        return _in_a_task(edges)
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = materialize(e, "edges")
    before = None
    for _ in range(max_rounds):
        large = materialize(_star(e, True), "large-star")
        small = materialize(_star(large, False), "small-star")
        release(e, large)
        e = small
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
