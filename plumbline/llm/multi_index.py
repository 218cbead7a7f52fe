"""Near-duplicate vectors by an inverted multi-index: two codebooks, a grid of cells, nearest cells first."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, written
from plumbline.llm.components import components

#: Distinct vectors that codebooks and the length of the traversal are fitted on, at most.
SAMPLE_ROWS = 16_384
#: Vectors a cell should hold, and words of a codebook, at least and at most.
CELL_ROWS, WORDS = 32, (4, 1024)
#: Share of pairs just at the threshold whose cells the traversal must reach.
RECALL = 0.95
#: Vectors on either side of one block of comparisons.
BLOCK_ROWS = 1024


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared, up to a constant for each point."""
    return (centres**2).sum(axis=1) - 2 * points @ centres.T


def _codebook(points: np.ndarray, size: int, seed: int) -> np.ndarray:
    centres = points[np.random.default_rng(seed).choice(len(points), size, replace=False)].copy()
    for _ in range(12):
        own = _distances(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        count = np.bincount(own, minlength=size)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


class MultiIndex:
    """Codebooks of both halves of the vectors of one dimension, and how many cells a traversal visits."""

    def __init__(self, sample: np.ndarray, rows: int, threshold: float):
        """sample: vectors, one per row; rows: how many there are in all."""
        sample = _unit(sample)
        self.half = sample.shape[1] // 2
        size = min(max(int(math.sqrt(rows / CELL_ROWS)), WORDS[0]), WORDS[1], len(sample))
        self.size = size
        self.books = [
            _codebook(part, size, seed) for seed, part in enumerate((sample[:, : self.half], sample[:, self.half :]))
        ]
        self.visits = self._needed(sample[:2048], threshold)
        ranks = [(i, j) for i in range(min(size, self.visits)) for j in range(min(size, self.visits // (i + 1)))]
        #: Ranks in both halves that the first `visits` cells can have: rank (i, j) comes after (i+1)(j+1)-1 cells.
        self.front = np.array(ranks).T

    def _halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(vectors[:, : self.half], self.books[0]), _distances(vectors[:, self.half :], self.books[1])

    def _needed(self, sample: np.ndarray, threshold: float) -> int:
        """Cells to visit so that RECALL of the pairs at the threshold meet, by neighbours made for the sample."""
        noise = np.random.default_rng(7).standard_normal(sample.shape)
        noise = noise - (noise * sample).sum(axis=1, keepdims=True) * sample
        norm = np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        near = threshold * sample + math.sqrt(1 - threshold**2) * noise / norm
        first, second = self._halves(sample)
        row = np.arange(len(sample))
        near_first, near_second = (x.argmin(axis=1) for x in self._halves(near))
        limit = first[row, near_first] + second[row, near_second]
        second = np.sort(second, axis=1)
        before = [np.searchsorted(b, c - a).sum() for a, b, c in zip(first, second, limit, strict=True)]
        return max(1, min(int(np.quantile(before, RECALL)) + 1, self.size**2))

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each unit vector, and the cells that its traversal visits."""
        first, second = self._halves(vectors)
        order = [np.argsort(x, axis=1, kind="stable") for x in (first, second)]
        ordered = [np.take_along_axis(x, o, 1) for x, o in zip((first, second), order, strict=True)]
        sums = ordered[0][:, self.front[0]] + ordered[1][:, self.front[1]]
        wanted = min(self.visits, sums.shape[1])
        nearest = np.argpartition(sums, wanted - 1, axis=1)[:, :wanted]
        visited = np.take_along_axis(order[0], self.front[0][nearest], 1) * self.size
        visited = visited + np.take_along_axis(order[1], self.front[1][nearest], 1)
        return order[0][:, 0] * self.size + order[1][:, 0], visited


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of float64 from a column of their bytes, all of one length."""
    return np.frombuffer(b"".join(vectors.to_pylist()), np.float64).reshape(len(vectors), -1)


def _places(nodes: DataFrame, indexes: dict[int, MultiIndex]) -> DataFrame:
    """One row for each vector in its own cell (side 0) and in each visited cell of a higher number (side 1).

    Of two vectors in different cells the one in the lower cell looks for the other, so each pair can meet once.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(indexes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                sizes = np.array([len(x) for x in batch.column("embedding").to_pylist()])
                for size in np.unique(sizes):
                    rows = np.flatnonzero(sizes == size)
                    taken = batch.take(pa.array(rows))
                    flat = taken.column("embedding").flatten().to_numpy(zero_copy_only=False)
                    vectors = _unit(flat.astype(np.float64).reshape(len(rows), size))
                    index = shared.value.get(int(size))
                    if index is None:  # a length that the sample has missed: one cell
                        own, seen = np.zeros(len(rows), np.int64), np.zeros((len(rows), 0), np.int64)
                    else:
                        own, seen = index.cells(vectors)
                    who, which = np.nonzero(seen > own[:, None])
                    at = np.concatenate([np.arange(len(rows)), who])
                    cell = np.concatenate([own, seen[who, which]]) * (1 << 20) + size
                    side = np.concatenate([np.zeros(len(rows), np.int32), np.ones(len(who), np.int32)])
                    packed = pa.array([x.tobytes() for x in vectors], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell),
                            pa.array(side),
                            taken.column("node").take(pa.array(at)),
                            taken.column("weight").take(pa.array(at)),
                            packed.take(pa.array(at)),
                        ],
                        ["cell", "side", "node", "weight", "vector"],
                    )

    return nodes.mapInArrow(run, "cell long, side int, node long, weight long, vector binary")


def _blocks(places: DataFrame) -> DataFrame:
    """Deals each cell into blocks of bounded size: members against members, members against visitors.

    Copies of a row go to every block that it takes part in; a cell of ordinary size is one block.
    """
    sizes = places.groupBy("cell").agg(
        F.ceil(F.count_if(F.col("side") == 0) / BLOCK_ROWS).alias("members"),
        F.ceil(F.count_if(F.col("side") == 1) / BLOCK_ROWS).alias("visitors"),
    )
    dealt = places.join(sizes, "cell").where("members > 0")
    part = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("members")).otherwise(F.col("visitors")))
    # As side 0 of (block, versus) or as side 1; versus counts member blocks first, then visitor blocks.
    everyone = F.sequence(F.lit(0).cast("long"), F.col("members") - 1)
    others = F.sequence(F.lit(0).cast("long"), F.col("members") + F.col("visitors") - 1)
    as_left = F.transform(
        F.filter(others, lambda v: v >= F.col("part")),
        lambda v: F.struct(F.col("part").alias("block"), v.alias("versus"), F.lit(0).alias("side")),
    )
    as_right = F.transform(
        F.filter(everyone, lambda b: b < F.col("part")),
        lambda b: F.struct(b.alias("block"), F.col("part").alias("versus"), F.lit(1).alias("side")),
    )
    visiting = F.transform(
        everyone,
        lambda b: F.struct(b.alias("block"), (F.col("members") + F.col("part")).alias("versus"), F.lit(1).alias("side")),
    )
    copies = F.when(F.col("side") == 0, F.concat(as_left, as_right)).otherwise(visiting)
    return (
        dealt.withColumn("part", part)
        .select("cell", "node", "weight", "vector", F.explode(copies).alias("copy"))
        .select("cell", "copy.block", "copy.versus", "copy.side", "node", "weight", "vector")
    )


def _forest(rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that each of n is connected with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[rows], root[cols])
        before = root.copy()
        for end in (rows, cols):
            np.minimum.at(root, end, low)
            np.minimum.at(root, before[end], low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _compared(blocks: DataFrame, threshold: float) -> DataFrame:
    """For each block: how many vectors each vector links with there, and a root it is connected with."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        vectors = _matrix(table.column("vector").combine_chunks())
        order = np.lexsort((node, side))
        side, node, weight, vectors = side[order], node[order], weight[order], vectors[order]
        left = int((side == 0).sum())
        alone = table.column("block")[0] == table.column("versus")[0]
        others = vectors[:left] if alone else vectors[left:]
        near = vectors[:left] @ others.T >= threshold
        if alone:
            near = np.triu(near, 1)
        a, b = np.nonzero(near)
        b = b if alone else b + left
        links = np.bincount(a, weight[b], len(node)) + np.bincount(b, weight[a], len(node))
        root = _forest(a, b, len(node))
        linked = np.flatnonzero(links)
        return pa.table(
            {"node": node[linked], "links": links[linked].astype(np.int64), "root": node[root[linked]]}
        )

    return blocks.groupBy("cell", "block", "versus").applyInArrow(run, "node long, links long, root long")


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9
) -> DataFrame:
    """Links and components of vectors whose cosine, in double precision, is at least the threshold.

    One row per input row: `vec_id`, `n_links` (other rows linked directly), `component_id` (the
    smallest vec_id reachable by links, itself included), `kept` (the row's id is its component).
    Codebooks and the number of visited cells are fitted on at most SAMPLE_ROWS distinct vectors; all
    vectors are indexed and compared, and no pair below the threshold is linked. Pairs whose cells the
    traversal does not reach are missed, about 1 - RECALL of those just at the threshold.

    Equal vectors are compared once. Vectors that are null, empty, zero, or hold null or non-finite
    components, and rows without an id, link with nothing; their component is their id. Only vectors of
    one length are compared. Repeated rows count as rows. Other columns are ignored, whatever their names.
    """
    given = vectors.select(column(vec_id).cast("long").alias("vec_id"), column(embedding).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(finite & nonzero & F.col("vec_id").isNotNull(), F.lit(False))
    given = given.withColumn("embedding", F.when(usable, F.col("embedding"))).withColumn("hash", F.xxhash64("embedding"))

    distinct = given.where("embedding IS NOT NULL").groupBy("hash", "embedding")
    nodes = distinct.agg(F.count("*").alias("weight"), F.min("vec_id").alias("low"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")

    sample = nodes.orderBy("hash").limit(SAMPLE_ROWS).select("embedding").toArrow().column(0).to_pylist()
    rows = {r[0]: r[1] for r in nodes.groupBy(F.size("embedding")).count().orderBy(F.desc("count")).limit(64).collect()}
    indexes = {}
    for size, n in rows.items():
        own = np.array([x for x in sample if len(x) == size], np.float64)
        if size > 1 and len(own):
            indexes[size] = MultiIndex(own, n, threshold)

    found = written(_compared(_blocks(_places(nodes, indexes)), threshold), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    belongs = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (
        nodes.select("hash", "embedding", "weight", "low", "node")
        .join(links, "node", "left")
        .join(belongs, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    lowest = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = known.join(lowest, "component").select(
        "hash",
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        "component_id",
    )
    component = F.coalesce("component_id", "vec_id")
    return given.join(known, ["hash", "embedding"], "left").select(
        F.col("vec_id").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
