"""Benchmark passages in documents: shared q-grams counted in diagonal bands, then banded alignment.

By the q-gram lemma a passage of m characters, copied with at most k edits, keeps m - q + 1 - kq of its
q-grams, and those lie on at most k + 1 neighbouring diagonals. Diagonals are gathered in bands of
2(k + 1) that overlap by half, so one band has them all; bands with too few are out. Short passages keep
no q-gram for certain: they are cut into k + 1 seeds, of which one is copied as it is.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, slices

#: Characters of a q-gram, and edits per character of a passage.
Q, EDIT_RATE = 8, 0.1
#: Items with fewer characters than this are searched by seeds, not by q-grams.
LEAST_CHARS = 24
#: A longer item is searched in pieces of about this length, each a passage of its own.
PIECE_CHARS = 512
#: Characters of the items that one pass over the documents looks for.
BLOCK_CHARS = 1 << 20
#: Characters of a document that are searched at once.
CHUNK_CHARS = 1 << 20

_FILTER_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STOP = np.uint32(0x110000)
_LOWER = np.arange(0x10000, dtype=np.uint32)
for _c in range(0x10000):
    if not 0xD800 <= _c < 0xE000 and len(_low := chr(_c).lower()) == 1:
        _LOWER[_c] = ord(_low)
_SPACE = np.zeros(0x10000, bool)
_SPACE[[c for c in range(0x10000) if chr(c).isspace()]] = True


def _normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case, each run of white space as one space, and where each stands in the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = points < 0x10000
    points = np.where(low, _LOWER[np.where(low, points, 0)], points)
    space = np.where(low, _SPACE[np.where(low, points, 0)], False)
    kept = np.flatnonzero(~space | np.r_[True, ~space[:-1]]) if len(points) else np.zeros(0, np.int64)
    points = np.where(space, np.uint32(32), points)[kept]
    return points, kept


def _grams(points: np.ndarray) -> np.ndarray:
    """A hash of the Q characters from each position on, by doubling."""
    h, size, power = points.astype(np.uint64), 1, _MIX
    with np.errstate(over="ignore"):
        while size < Q:
            h = h[:-size] * power + h[size:]
            power, size = power * power, size * 2
        return h * _MIX


def _runs(points: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` characters from each position on."""
    count = max(len(points) - size + 1, 0)
    h = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            h = h * _MIX + points[i : i + count]
    return h


class PassageIndex:
    """The q-grams of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item: list[int] = []
        self.points: list[np.ndarray] = []
        for item, text in items:
            points, _ = _normal((text or "").strip())
            if not len(points):
                continue
            for piece in np.array_split(points, -(-len(points) // PIECE_CHARS)):
                self.item.append(item)
                self.points.append(piece)
        self.size = np.array([len(x) for x in self.points], np.int64)
        self.edits = (self.size * EDIT_RATE).astype(np.int64)
        # Too few q-grams would be left for sure after so many edits: such passages are found by seeds.
        short = (self.size < LEAST_CHARS) | ((self.size - Q) // Q < self.edits)
        self.least = self.size - Q + 1 - self.edits * Q
        grams = [np.zeros(0, np.uint64) if s else _grams(x) for x, s in zip(self.points, short.tolist(), strict=True)]
        seeds: dict[int, list[tuple[int, int, int]]] = {}  # by length: hash, passage, place
        for p in np.flatnonzero(short).tolist():
            place = 0
            for seed in np.array_split(self.points[p], self.edits[p] + 1):
                seeds.setdefault(len(seed), []).append((int(_runs(seed, len(seed))[0]), p, place))
                place += len(seed)
        self.seeds = {}
        for length, rows in seeds.items():
            hashes, passage, place = zip(*sorted(rows), strict=True)
            self.seeds[length] = np.array(hashes, np.uint64), np.array(passage), np.array(place)
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        passage = np.repeat(np.arange(len(grams)), [len(x) for x in grams])
        place = np.concatenate([np.arange(len(x)) for x in grams]) if grams else np.zeros(0, np.int64)
        self.passage, self.place = passage[order], place[order]
        self.hashes, self.first, self.times = np.unique(hashes[order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - _FILTER_BITS)] = True
        self.reach = int((self.size + 4 * self.edits + 4).max()) if len(self.size) else 0

    def candidates(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages and the first diagonals of the bands in which they share enough q-grams with the text."""
        if len(text) < Q or not len(self.hashes):
            return (np.zeros(0, np.int64),) * 2
        hashes = _grams(text)
        at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _FILTER_BITS)])
        hashes = hashes[at]
        found = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        real = self.hashes[found] == hashes
        at, found = at[real], found[real]
        times = self.times[found]
        post = np.arange(times.sum()) + np.repeat(self.first[found] - (np.cumsum(times) - times), times)
        passage = self.passage[post]
        diagonal = np.repeat(at, times) - self.place[post] + self.reach  # never below 0
        width = self.edits[passage] + 1
        band = diagonal // width
        key = np.concatenate([passage * (1 << 40) + band, passage * (1 << 40) + np.maximum(band - 1, 0)])
        key, count = np.unique(key, return_counts=True)
        passage, band = key >> 40, key & ((1 << 40) - 1)
        enough = count >= self.least[passage]
        passage, band = passage[enough], band[enough]
        return passage, band * (self.edits[passage] + 1) - self.reach

    def seeded(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Short passages, and the diagonals on which the text has one of their seeds."""
        for length, (hashes, passage, place) in self.seeds.items():
            found = _runs(text, length)
            at = np.flatnonzero(np.isin(found, hashes))
            low, high = (np.searchsorted(hashes, found[at], side) for side in ("left", "right"))
            times = high - low
            post = np.arange(times.sum()) + np.repeat(low - (np.cumsum(times) - times), times)
            yield passage[post], np.repeat(at, times) - place[post]

    def align(self, text: np.ndarray, passage: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Edits, start and end of the best alignment of each passage around its band, all at once, row by row.

        A cell holds edits * 2**32 + start, so that the least cell also has the first start. No alignment
        goes over a _STOP, so that each stays in one document.
        """
        cost = np.int64(1) << 32
        edits = self.edits[passage]
        before = edits + 1  # the alignment may leave the band by as many diagonals as it has edits
        wide = int((2 * (edits + 1) + 2 * before).max()) + 1
        low = diagonal - before
        place = np.arange(wide, dtype=np.int64)
        inside = place < (2 * (edits + 1) + 2 * before)[:, None]
        starts = low[:, None] + place
        never = cost * 100_000
        size = self.size[passage]
        cells = np.where(inside & (starts >= 0) & (starts <= len(text)), np.maximum(starts, 0), never)
        best = np.full((len(passage), 3), -1, np.int64)
        chars = np.full((len(passage), int(size.max())), _STOP + 1, np.uint32)
        for row, p in enumerate(passage):
            chars[row, : size[row]] = self.points[p]
        padded = np.concatenate([text, [_STOP]])
        stops = np.r_[0, np.cumsum(text == _STOP)]
        steps = place * cost
        for i in range(1, chars.shape[1] + 1):
            at = starts + (i - 1)
            there = padded[np.where((at >= 0) & (at < len(text)), at, len(text))]
            same = cells + np.where(there == chars[:, i - 1, None], 0, cost)
            same = np.where(there == _STOP, never, same)
            skip = np.concatenate([cells[:, 1:], np.full((len(cells), 1), never)], axis=1) + cost
            cells = np.minimum(same, skip)
            cells = np.where(inside, cells, never)
            # What follows a stop lies lower than all before it, so that only cells of one document meet.
            after = stops[np.clip(starts + i, 0, len(text))]
            after = steps + (after - after[:, :1]) * (2 * never)
            cells = np.minimum.accumulate(cells - after, axis=1) + after
            over = np.flatnonzero(size == i)
            if len(over):
                column_ = cells[over].argmin(axis=1)
                value = cells[over, column_]
                best[over] = np.stack([value >> 32, value & 0xFFFFFFFF, low[over] + column_ + i], axis=1)
        return best

    def matches(self, text: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Passage, edits, start and end of every occurrence within the passage's budget."""
        for passage, diagonal in (self.candidates(text), *self.seeded(text)):
            for start in range(0, len(passage), 256):
                some = passage[start : start + 256]
                best = self.align(text, some, diagonal[start : start + 256])
                for p, (edits, first, end) in zip(some, best, strict=True):
                    if edits <= self.edits[p]:
                        yield int(p), int(edits), int(first), int(end)


def _chunks(text: str, overlap: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a text that overlap by as many normal characters as a match can have."""
    for start in range(0, max(len(text), 1), CHUNK_CHARS):
        stop = start + CHUNK_CHARS
        tail = overlap
        while stop < len(text) and stop + tail < len(text) and len(_normal(text[stop : stop + tail])[0]) < overlap:
            tail *= 2
        points, places = _normal(text[start : stop + tail])
        yield start, points, places


def _found(batch: pa.RecordBatch, index: PassageIndex) -> Iterator[tuple[int, int, int, int, int]]:
    """Row, item, start, end and edits of the matches in a slice of documents, best first, none overlapping."""
    rows, starts, points, places = [], [], [], []
    for row, text in enumerate(batch.column("text").to_pylist()):
        if text:
            for start, chars, where in _chunks(text, index.reach):
                rows.append(row)
                starts.append(start)
                points += [chars, np.array([_STOP])]
                places.append(where)
    if not rows:
        return
    ends = np.cumsum([len(x) + 1 for x in places])
    everything = np.concatenate(points).astype(np.uint32)
    found = []
    for p, edits, first, end in index.matches(everything):
        part = int(np.searchsorted(ends, first, side="right"))
        begin = int(ends[part]) - len(places[part]) - 1
        if end > ends[part] - 1 or end <= first:
            continue
        where = places[part]
        at, to = starts[part] + int(where[first - begin]), starts[part] + int(where[end - 1 - begin]) + 1
        found.append((rows[part], index.item[p], edits, at, to))
    taken: dict[tuple, list] = {}
    for row, item, edits, at, to in sorted(found, key=lambda x: (x[0], x[1], x[2], x[3], x[4])):
        own = taken.setdefault((row, item), [])  # in order
        i = bisect(own, (at, to))
        if (not i or own[i - 1][1] <= at) and (i == len(own) or to <= own[i][0]):
            own.insert(i, (at, to))
            yield row, item, at, to, edits


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Passages of the benchmark in documents: `doc_id`, `item_id`, `start`, `end`, `edits`.

    One row per occurrence, best first where those of one item overlap; start and end are code points of
    the text, end exclusive. Case and the amount of white space don't count; otherwise a passage of m
    characters may differ by EDIT_RATE * m edits. Documents without a passage give no row; null and empty
    texts have none. Empty and null items match nothing; of items longer than PIECE_CHARS,
    each piece is a passage. Repeated documents and items give their rows again; a null id is kept. Very long texts
    are searched in overlapping chunks; empty tables give no rows.

    The documents are read once for each BLOCK_CHARS characters of the benchmark; only the items of one
    block are in memory. Other columns are ignored, whatever their names.
    """
    docs = documents.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))
    items = benchmark.select(column(item_id).cast("long").alias("item_id"), column(item_text).alias("text"))
    blocks = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS))
    parts = [
        _of_block(docs, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect())
        for block in range(blocks)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.toDF(doc_id, item_id, "start", "end", "edits")


def _of_block(docs: DataFrame, items: list) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(PassageIndex([(r["item_id"], r["text"]) for r in items]))
    names = ["item_id", "start", "end", "edits"]
    schema = "doc_id long, item_id long, start long, end long, edits int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            rows = list(_found(batch, shared.value))
            if rows:
                at, *columns = zip(*rows, strict=True)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]
                arrays = [pa.array(x, t) for x, t in zip(columns, types, strict=True)]
                ids = batch.column("doc_id").take(pa.array(at))
                yield pa.RecordBatch.from_arrays([ids, *arrays], ["doc_id", *names])

    return docs.mapInArrow(run, schema)
