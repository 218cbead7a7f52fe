"""Documents whose sets of word shingles have a high Jaccard similarity, by a grouped prefix join.

Two sets that are similar enough share a shingle among the first few of both, whatever the order, if it
is the same for all. Rare shingles come first, so lists of documents that share one are short.
Documents with equal sets are one node; nodes with equal prefixes and sizes are one group, and lists
hold groups. Only which documents hang together is asked for: in a long list each group is first
compared with a few leaders, and after that only groups which are not yet connected with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.common import column, packed, slices, unpacked, written
from plumbline.llm.components import components
from plumbline.llm.shingles import distinct, mixed, shingles

THRESHOLD = 75
#: Bins in which the shingles of all documents are counted, to know the frequent ones.
BINS_LOG2 = 18
#: In lists of up to this many groups all pairs are compared at once; longer ones have so many leaders.
SHORT, LEADERS = 64, 16
#: Rows that a part of a very frequent shingle's list should have.
PART_ROWS = 4096
#: Groups of a long list that one task compares with all others of the list.
MEET_ROWS = 1 << 14
#: Sets that a task remembers, so as not to list copies again.
REMEMBERED = 1 << 18

_BATCH = pa.schema([("kind", pa.int8()), ("x", pa.int64()), ("y", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])
_PAIR, _MEMBER, _LEADER, _LED = 0, 1, 2, 3


def prefix_size(n, threshold: int):
    """How many of a set's n shingles are its prefix."""
    return n + (threshold * n * -1) // 100 + 1


def _enough(overlap, n_a, n_b, threshold: int):
    """Whether sets of these sizes with this overlap reach the threshold; holds for columns, too."""
    return (100 + threshold) * overlap >= threshold * (n_a + n_b)


class Frequencies:
    """For each bin of shingles, how far above the mean it is, and how many parts its lists have."""

    def __init__(self, counts: np.ndarray):
        mean = max(counts.sum() / len(counts), 1.0)
        self.level = np.maximum(np.log2(np.maximum(counts, 1) / mean) * 2, 0).astype(np.uint8)
        heavy = (counts > 4 * PART_ROWS) & (counts > 8 * mean)
        self.parts = np.where(heavy, np.minimum(counts // PART_ROWS, 255), 0).astype(np.uint8)


def _frequencies(docs: DataFrame) -> Frequencies:
    """Counts every shingle of every document in a fixed number of bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BINS_LOG2, np.int64)
        for batch in slices(batches, "text"):
            values, _ = shingles([x or b"" for x in batch.column("text").to_pylist()])
            counts += np.bincount(values >> np.uint64(64 - BINS_LOG2), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["bin", "n"])

    rows = docs.select("text").mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << BINS_LOG2, np.int64)
    counts[rows.column("bin").to_numpy()] = rows.column("n").to_numpy()
    return Frequencies(counts)


def _sums(values: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each text's set of values, whatever their order."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values + np.uint64(seed)))])
        stops = np.cumsum(size)
        return mixed(total[stops] - total[stops - size] + size.astype(np.uint64) * np.uint64(2 * seed + 1))


def _outline_bins(n: int) -> int:
    """How many bins the outline of a set of n values has: somewhat more than values, as far as 2^14 go."""
    return 1 << min(max(n.bit_length(), 4), 14)


def _outline(values: np.ndarray) -> bytes:
    """How many values of a set fall in each bin; an outline goes along with every pair of its set, and so is kept short.

    Each bin is so many ones and a zero, less than three bits to a value. With very many values to a bin each bin is a
    byte, 255 standing for any more.
    """
    bins = _outline_bins(len(values))
    counts = np.bincount(values >> np.uint64(65 - bins.bit_length()), minlength=bins)
    if len(values) > 7 * bins:
        return np.minimum(counts, 255).astype(np.uint8).tobytes()
    bits = np.ones(len(values) + bins, np.uint8)
    bits[np.cumsum(counts) + np.arange(bins)] = 0
    return np.packbits(bits).tobytes()


@lru_cache(maxsize=64)
def _outline_counts(outline: bytes, n: int) -> np.ndarray | None:
    """The counts that the outline of a set of n values tells, if it tells all."""
    bins, given = _outline_bins(n), np.frombuffer(outline, np.uint8)
    if n > 7 * bins:
        return None if (given == 255).any() else given.astype(np.int64)
    ends = np.flatnonzero(np.unpackbits(given, count=n + bins) == 0)
    ends[1:] -= ends[:-1] + 1
    return ends


def _overlap_bound(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """What the overlap of two sets can be at most, given their outlines and sizes."""
    x, y = _outline_counts(a, n_a), _outline_counts(b, n_b)
    if x is None or y is None:
        return min(n_a, n_b)
    size = min(len(x), len(y))
    x, y = (o if len(o) == size else o.reshape(size, -1).sum(axis=1) for o in (x, y))
    return int(np.minimum(x, y).sum())


class _Prefixes:
    """Nodes, groups and prefixes of a slice of texts."""

    def __init__(self, texts: list[bytes], frequent: Frequencies, threshold: int):
        values, size = distinct(*shingles(texts))
        self.size = size
        self.node = _sums(values, size, 1).view(np.int64)
        bins = values >> np.uint64(64 - BINS_LOG2)
        level = frequent.level[bins].astype(np.uint64)
        order = (level << np.uint64(56)) | (values >> np.uint64(8))
        stops = np.cumsum(size)
        for a, b in zip(stops - size, stops, strict=True):
            order[a:b].sort()
        length = np.where(size > 0, prefix_size(size, threshold), 0)
        place = np.arange(len(order)) - np.repeat(stops - size, size)
        first = place < np.repeat(length, size)
        self.length, self.place = length, place[first]
        self.token = order[first] & np.uint64((1 << 56) - 1)
        self.values, self.stops = values, stops
        self.group = (_sums(self.token, length, 3) ^ mixed(size.astype(np.uint64))).view(np.int64)
        self.parts = frequent.parts[self.token >> np.uint64(56 - BINS_LOG2)].astype(np.uint64)

    def outlines(self) -> list[bytes]:
        return [_outline(self.values[b - s : b]) for b, s in zip(self.stops.tolist(), self.size.tolist(), strict=True)]

    def lists(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """List, group, size and position of the prefixes of some rows; the last byte of a list is its part."""
        own = np.repeat(np.arange(len(self.size)), self.length)
        chosen = rows[own]
        own, token, parts = own[chosen], self.token[chosen], self.parts[chosen]
        spread = mixed(self.group[own].view(np.uint64) + np.uint64(17))
        part = np.where(parts > 0, spread % np.maximum(parts, 1) + np.uint64(1), np.uint64(0))
        return ((token << np.uint64(8)) | part).view(np.int64), self.group[own], self.size[own], self.place[chosen]


def _nodes(docs: DataFrame, frequent, threshold: int) -> DataFrame:
    """For each document its node, size, group and outline."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            p = _Prefixes([x or b"" for x in batch.column("text").to_pylist()], frequent.value, threshold)
            arrays = [batch.column("doc_id"), *map(pa.array, (p.node, p.size.astype(np.int64), p.group))]
            arrays.append(pa.array(p.outlines(), pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "node", "n", "group", "outline"])

    return docs.mapInArrow(run, "doc_id long, node long, n long, group long, outline binary")


def _lists(docs: DataFrame, frequent, threshold: int) -> DataFrame:
    """A row for each shingle in the prefix of a group; copies that a task has seen are not listed again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            p = _Prefixes([x or b"" for x in batch.column("text").to_pylist()], frequent.value, threshold)
            fresh = np.zeros(len(p.group), bool)
            for i, group in enumerate(p.group.tolist()):
                if group not in seen:
                    fresh[i] = True
                    seen.add(group)
            if len(seen) > REMEMBERED:
                seen = set()
            list_, group, n, pos = p.lists(fresh & (p.size > 0))
            arrays = [pa.array(list_), pa.array(group), pa.array(n, pa.int32()), pa.array(pos, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["list", "group", "n", "pos"])

    return docs.where("doc_id IS NOT NULL").mapInArrow(run, "list long, group long, n int, pos int")


def _possible(a: tuple, b: tuple, threshold: int) -> np.ndarray:
    """Whether sizes and positions of a shared shingle allow for enough overlap."""
    (n_a, pos_a), (n_b, pos_b) = a, b
    sizes = 100 * np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b)
    return sizes & _enough(np.minimum(n_a - pos_a, n_b - pos_b), n_a, n_b, threshold)


def _scan(lists: DataFrame, threshold: int) -> DataFrame:
    """Reads the sorted lists in a stream: pairs of the short ones; members, leaders and led pairs of the long ones.

    A member of a long list is met by its first LEADERS groups only, so that no list is held in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)
        open_long = False  # the held rows are leaders of a list that goes on
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("list", "group", "n", "pos")])
            old = held.shape[1] if open_long else 0
            rows = np.concatenate([held, rows], axis=1)
            fresh = np.ones(rows.shape[1], bool)
            fresh[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
            rows = rows[:, fresh]  # copies of one group from several tasks
            if not rows.shape[1]:
                continue
            starts = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])
            size = np.diff(np.r_[starts, rows.shape[1]])
            long_ = (size > SHORT) | ((rows[0, starts] & 255) > 0)
            long_[0] |= open_long
            stay = not long_[-1]  # a short list at the end waits for the rest of it
            until = int(starts[-1]) if stay else rows.shape[1]
            yield from _pairs(rows[:, :until], starts, size, long_, old, threshold)
            held = rows[:, until:] if stay else rows[:, starts[-1] :][:, :LEADERS]
            open_long = not stay
        if not open_long and held.shape[1]:
            one = np.zeros(1, np.int64)
            yield from _pairs(held, one, np.array([held.shape[1]]), np.zeros(1, bool), 0, threshold)

    return lists.mapInArrow(run, "kind tinyint, x long, y long, n int, pos int")


def _pairs(rows, starts, size, long_, old: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """old: rows at the start that were given out before."""
    if not rows.shape[1]:
        return
    used = starts < rows.shape[1]
    starts, size, long_ = starts[used], size[used], long_[used]
    own = np.repeat(np.arange(len(starts)), size)
    list_, group, n, pos = rows

    def pairs(kind: int, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        good = _possible((n[a], pos[a]), (n[b], pos[b]), threshold)
        a, b = a[good], b[good]
        if len(a):
            low, high = np.minimum(group[a], group[b]), np.maximum(group[a], group[b])
            yield _batch(kind, low, high, np.zeros(len(a)), np.zeros(len(a)))

    short = ~long_
    for gap in range(1, int(size[short].max(initial=0))):
        lists = np.flatnonzero(short & (size > gap))
        a = np.flatnonzero(np.isin(own, lists)) if len(lists) < len(starts) // 2 else np.flatnonzero(short[own])
        a = a[a + gap < starts[own[a]] + size[own[a]]]
        yield from pairs(_PAIR, a, a + gap)
    member = np.flatnonzero(long_[own])
    if not len(member):
        return
    for k in range(LEADERS):
        later = member[member > starts[own[member]] + k]
        later = later[later >= old]
        yield from pairs(_LED, starts[own[later]] + k, later)
    given = member[member >= old]
    yield _batch(_MEMBER, (list_[given].view(np.uint64) >> np.uint64(8)).view(np.int64), group[given], n[given], pos[given])
    first = starts[long_ & ((list_[starts] & 255) > 0)]
    first = first[first >= old]
    yield _batch(_LEADER, (list_[first].view(np.uint64) >> np.uint64(8)).view(np.int64), group[first], n[first], pos[first])


def _batch(kind: int, x, y, n, pos) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(x), kind), pa.int8()),
            pa.array(x, pa.int64()),
            pa.array(y, pa.int64()),
            pa.array(np.asarray(n).astype(np.int32)),
            pa.array(np.asarray(pos).astype(np.int32)),
        ],
        schema=_BATCH,
    )


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The whole sets of the wanted nodes; wanted: `node` and the id of a document that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed", 2 << 20):
            values, size = distinct(*shingles(unpacked(batch)))
            node = _sums(values, size, 1).view(np.int64)
            right = node == batch.column("node").to_numpy()  # several documents may have one id
            offsets = np.concatenate([[0], np.cumsum(size[right])]).astype(np.int32)
            kept = values[np.repeat(right, size)].view(np.int64)
            sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept))
            yield pa.RecordBatch.from_arrays([pa.array(node[right]), sets], ["node", "set"])

    # Both sides grow with the corpus: never a broadcast, at any size.
    # A repeated row gives its set again, which only gives its links again.
    rows = packed(docs).join(wanted.hint("merge"), "doc_id").select("node", "size", "packed")
    return rows.mapInArrow(run, "node long, set array<long>")


def _promising(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """The pairs of nodes whose outlines allow for enough overlap, and that overlap by the sum of sizes."""
    a, b = (
        nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("outline").alias(f"outline_{c}"))
        for c in "ab"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()
            outlines = batch.column("outline_a").to_pylist(), batch.column("outline_b").to_pylist()
            rows = zip(*outlines, n_a, n_b, strict=True)
            most = np.array([_overlap_bound(x, y, i, j) for x, y, i, j in rows], np.int64)
            sizes = np.array(n_a, np.int64) + np.array(n_b, np.int64)
            out = [batch.column("a"), batch.column("b"), pa.array(most / np.maximum(sizes, 1))]
            kept = pa.array(_enough(most, sizes, 0, threshold))
            yield pa.RecordBatch.from_arrays(out, ["a", "b", "most"]).filter(kept)

    names = pairs.columns
    both = pairs.toDF("a", "b").join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    both = both.select("a", "b", "n_a", "n_b", "outline_a", "outline_b")
    return both.mapInArrow(run, "a long, b long, most double").toDF(*names, "most")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs of nodes that reach the threshold."""
    # Of the sets only those of these pairs are sent anywhere, if the pairs are few.
    pairs = written(pairs, "pairs")
    sets = sets.join(_nodes_of(pairs), "node", "left_semi")
    a = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(_enough(shared, F.size("set_a"), F.size("set_b"), threshold)).select("a", "b")


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _ordered(a: str | Column, b: str | Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def similar_documents(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """Components of documents linked by similar shingle sets: `doc_id`, `n_shingles`, `component_id`.

    Sets are the distinct runs of five words of whole texts, A-Z in lower case, words being runs of
    characters other than blank, tab and line breaks; a shorter text is one run, a text without words is
    empty and linked with nothing, like a null text. Two documents are linked if the intersection of
    their sets is at least threshold percent of the union; no link is missed. One row per input row,
    repeated rows included; `component_id` is the smallest id reachable by links, itself included. Rows
    without an id are linked with nothing, and have no component; an empty table gives no rows. Texts of any
    length are read whole. Other columns are ignored, whatever their names. Shingles and sets are compared by 64-bit hashes.
    """
    docs = documents.select(
        column(doc_id).cast("long").alias("doc_id"), column(text).cast("binary").alias("text")
    )
    frequent = docs.sparkSession.sparkContext.broadcast(_frequencies(docs))
    base = written(_nodes(docs, frequent, threshold), "shingle-nodes")
    known = base.where("n > 0 AND doc_id IS NOT NULL").groupBy("node", "group")
    nodes = known.agg(*(F.min(c).alias(c) for c in ("doc_id", "n", "outline")))
    nodes = written(nodes, "nodes")
    lists = _lists(docs, frequent, threshold).repartition("list").sortWithinPartitions("list", "group")
    found = written(_scan(lists, threshold), "lists")

    pairs = written(_promising(_candidates(found, nodes), nodes, threshold), "pairs")
    links = _connected(pairs, docs, nodes, threshold)
    belongs = written(_belongs(nodes, links), "belongs")

    # What the first nodes of groups, and the leaders of long lists, have left apart.
    members = found.where(F.col("kind") == _MEMBER).select(
        F.col("x").alias("token"), F.col("y").alias("group"), "n", "pos"
    )
    short = found.where(F.col("kind") == _PAIR).select(F.col("x").alias("group_a"), F.col("y").alias("group_b"))
    more = _promising(_across(members, short, belongs, threshold), nodes, threshold)
    more = written(more.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        belongs = _belongs(nodes, links.union(_connected(more, docs, belongs, threshold)))

    smallest = belongs.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = belongs.join(smallest, "component").select("node", "component_id")
    out = base.join(of_node, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), "doc_id"))
    return out.select(
        F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def _connected(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """Links among the pairs, enough of them to connect whatever is similar.

    Most pairs lie within clusters, so the likeliest pair of each node is verified first, and then only
    those that would still connect anything. nodes may know components already.
    """
    needed = _nodes_of(pairs)
    sets = written(_sets(docs, nodes.join(needed, "node").select("node", "doc_id")), "sets")
    best = pairs.groupBy("b").agg(F.max(F.struct("most", "a"))["a"].alias("a")).select("a", "b")
    best = written(best, "tried")
    links = written(_verified(best, sets, threshold), "links")
    if "component" in nodes.columns:
        own = [F.col("node").alias("a"), F.col("component").alias("b")]
        known = nodes.join(needed, "node").where("node <> component").select(*own)
        belongs = components(links.union(known))
    else:
        belongs = components(links)
    of_a, of_b = (belongs.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab")
    rest = pairs.select("a", "b").join(best, ["a", "b"], "left_anti").join(of_a, "a", "left").join(of_b, "b", "left")
    rest = rest.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
    return written(links.union(_verified(rest, sets, threshold)), "links")


def _belongs(nodes: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _candidates(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes to compare: those of groups, for which their first nodes stand, and others of a group with its first."""
    groups = nodes.groupBy("group").agg(F.min("node").alias("first"), F.count("*").alias("nodes"))
    pairs = found.where(F.col("kind").isin(_PAIR, _LED)).select(F.col("x").alias("a"), F.col("y").alias("b"))
    leaders = found.where(F.col("kind") == _LEADER).select("x", "y")
    chief = leaders.groupBy("x").agg(F.min("y").alias("chief"))
    of_parts = leaders.join(chief, "x").where("y > chief").select(F.col("chief").alias("a"), F.col("y").alias("b"))
    pairs = pairs.union(of_parts).distinct()
    first_a, first_b = (groups.select(F.col("group").alias(c), F.col("first").alias(f"first_{c}")) for c in "ab")
    between = pairs.join(first_a, "a").join(first_b, "b").select(*_ordered("first_a", "first_b"))
    within = nodes.join(groups.where("nodes > 1"), "group").where("node > first")
    return between.union(within.select(F.col("first").alias("a"), F.col("node").alias("b"))).distinct()


def _across(members: DataFrame, short: DataFrame, belongs: DataFrame, threshold: int) -> DataFrame:
    """Pairs of nodes from one long list, one pair of groups of a short list, or one group, which are in different components."""
    parted = belongs.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    of_group = belongs.select("group", "component").distinct()
    rows = members.join(of_group, "group")
    mixed_ = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rows = rows.join(mixed_.where("low <> high").select("token"), "token")
    # Only the first token that two groups share counts: they meet once, and positions bound what follows it.
    before = W.partitionBy("group", "component").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("earlier", F.collect_list("token").over(before))
    # The members of a frequent token are dealt over as many tasks as their number asks for, each with all the others.
    parts = rows.groupBy("token").agg(F.ceil(F.count("*") / MEET_ROWS).cast("int").alias("parts"))
    rows = written(rows.join(parts.hint("merge"), "token"), "members")
    own = F.pmod(F.xxhash64("group"), F.col("parts")).cast("int").alias("part")
    left = rows.select("*", own).drop("parts")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    right = rows.where("parts = 1").withColumn("part", F.lit(0)).union(rows.where("parts > 1").select("*", every))
    right = right.drop("parts")
    left = left.toDF(*(c if c in ("token", "part") else f"{c}_a" for c in left.columns))
    right = right.toDF(*(c if c in ("token", "part") else f"{c}_b" for c in right.columns))
    sizes = 100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")
    rest = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    places = _enough(rest, F.col("n_a"), F.col("n_b"), threshold)
    different = (F.col("group_a") <= F.col("group_b")) & (F.col("component_a") != F.col("component_b"))
    fresh = ~F.arrays_overlap("earlier_a", "earlier_b")
    across = left.join(right.hint("merge"), ["token", "part"]).where(different & sizes & places & fresh)
    across = across.select("group_a", "component_a", "group_b", "component_b")
    inside = parted.where("low <> high").select("group").join(of_group, "group")
    inside = inside.toDF("group_a", "component_a").join(inside.toDF("group_b", "component_b"), F.col("group_a") == F.col("group_b"))
    inside = inside.where("component_a < component_b").select("group_a", "component_a", "group_b", "component_b")
    # The first nodes of groups have met: only where a group has more of them is anything left to compare.
    nodes = belongs.groupBy("group").agg(F.count("*").alias("nodes"))
    between = short.distinct()
    for s in "ab":
        between = between.join(nodes.toDF(f"group_{s}", f"nodes_{s}"), f"group_{s}")
    between = between.where("nodes_a > 1 OR nodes_b > 1")
    for s in "ab":
        between = between.join(of_group.toDF(f"group_{s}", f"component_{s}"), f"group_{s}")
    between = between.where("component_a <> component_b").select("group_a", "component_a", "group_b", "component_b")
    pairs = across.union(inside).union(between).distinct()
    of = belongs.select("group", "component", "node")
    pairs = pairs.join(of.toDF("group_a", "component_a", "node_a"), ["group_a", "component_a"])
    pairs = pairs.join(of.toDF("group_b", "component_b", "node_b"), ["group_b", "component_b"])
    return pairs.select(*_ordered("node_a", "node_b")).distinct()
