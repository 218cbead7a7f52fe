"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import written

#: Links that one task holds at most, 16 bytes each; a graph, or what rounds have left of it, is then finished there.
TASK_LINKS = 1 << 21


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node: `node`, `component`.

    links: `a` and `b`, longs without nulls, in any direction, repeated or not, loops allowed. Nodes
    without a link to another are not returned. Graphs of up to TASK_LINKS links are finished in one task.
    Beyond that each round moves every node nearer to its smallest neighbour with sums per node and joins
    alone, so that a node with very many links is not gathered anywhere; rounds are written, and end when
    every node hangs on the root of its component.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while edges.count() > TASK_LINKS:
        parents = edges.groupBy("a").agg(F.count("*").alias("n"))
        inner = edges.select(F.col("b").alias("a")).distinct().join(edges.select("a").distinct(), "a", "left_semi")
        many = parents.where("n > 1").select("a").union(inner)
        if many.isEmpty():  # every node has one parent, and no parent has one
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", F.col("b").alias("component")).distinct()
            )
        edges = written(_small_star(_large_star(edges)), "links")
    return written(edges.coalesce(1).mapInArrow(_finished, "node long, component long"), "components")


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of all links of a task."""
    parts = [np.stack([b.column("a").to_numpy(), b.column("b").to_numpy()]) for b in batches if b.num_rows]
    if parts:
        nodes, places = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
        least = smallest_reachable(*places.reshape(2, -1), len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[least])], ["node", "component"])


def smallest_reachable(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """For each of the nodes 0, 1, ... the smallest one reachable by links from a to b, in either direction."""
    root = np.arange(count)
    while len(a):
        # The root of either end hangs on the smaller of both, then everything on the root of its root.
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to its smallest one, or to itself if it is smaller."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    moved = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of those."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least.hint("merge"), "a").where("b <> least")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.toDF("a", "b")).distinct()
