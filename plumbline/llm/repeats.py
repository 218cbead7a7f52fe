"""Long byte strings that repeat anywhere in the corpus, found by prefix-free parsing.

The rolling hash of a few bytes is taken everywhere; in each stretch as long as the repeats looked for,
the place of the least hash is its trigger. Neighbouring stretches with one trigger make a phrase, so
equal stretches lie in phrases of the same trigger, at the same distance from it. The parse is the
phrases of all texts; the dictionary holds each distinct one once. A phrase whose trigger occurs once
has no repeat; one that occurs twice is a repeat in full. Suffixes are compared only for the rest of the
dictionary: the suffixes of all phrases with one trigger are put in order, and neighbours that agree for
the whole length are repeats. That order, trigger by trigger, is the part of the corpus order that can
hold repeats; the texts' other suffixes are never sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, packed, slices, text_batches, unpacked, written
from plumbline.llm.shingles import mixed

#: Bytes that must repeat.
LENGTH = 400
#: Distinct phrases of one trigger whose suffixes one task puts in order; those of a more frequent
#: trigger are cut into PARTS, and these again, which go apart by the bytes that all their stretches share.
PHRASES, PARTS = 128, 8
#: Bytes of a text that are parsed at once.
CHUNK_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.random.default_rng(20_240_502).integers(0, 2**64, 256, np.uint64)
_PLACE = np.uint64((1 << 24) - 1)


def _trigger_size(length: int) -> int:
    """A power of two, about a sixth of the length."""
    return 1 << max(0, (length // 5).bit_length() - 1)


def _rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the bytes from each position on, by doubling."""
    h, have, power = _VALUES[data], 1, _BASE
    with np.errstate(over="ignore"):
        while have < size:
            h = h[:-have] * power + h[have:]
            power, have = power * power, have * 2
    return mixed(h)


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, from running minima of blocks."""
    n = len(key) - width + 1
    blocks = np.concatenate([key, np.full(-len(key) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def phrases(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Piece, first stretch, number of stretches and trigger hash of each phrase."""
    sizes = np.array([len(x) for x in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    size = _trigger_size(length)
    hashes = _rolling(data, size)
    key = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    trigger = _least(key, length - size + 1) & _PLACE
    ends = np.cumsum(sizes)
    at = np.arange(len(trigger))
    piece = np.repeat(np.arange(len(pieces)), sizes)[: len(trigger)]
    inside = at + length <= ends[piece]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (trigger[1:] != trigger[:-1])
    starts = np.flatnonzero(first)
    number = np.add.reduceat(inside.astype(np.int64), starts) if len(starts) else starts
    own = piece[starts]
    return own, starts - (ends - sizes)[own], number, hashes[trigger[starts].astype(np.int64)]


def _pieces(texts: list[bytes | None], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Row, offset and bytes of pieces, about CHUNK_BYTES at a time; those of one text overlap by length - 1."""
    rows, offsets, pieces, size = [], [], [], 0
    for row, text in enumerate(texts):
        for start in range(0, len(text or b"") - length + 1, CHUNK_BYTES):
            rows.append(row)
            offsets.append(start)
            pieces.append(text[start : start + CHUNK_BYTES + length - 1])
            size += len(pieces[-1])
            if size >= CHUNK_BYTES:
                yield rows, offsets, pieces
                rows, offsets, pieces, size = [], [], [], 0
    if pieces:
        yield rows, offsets, pieces


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _parse(docs: DataFrame, length: int) -> DataFrame:
    """The phrases of all texts: trigger, digest of the phrase, and where it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            ids, hashes = (batch.column(c).to_numpy() for c in ("id", "hash"))
            for rows, offsets, pieces in _pieces(batch.column("text").to_pylist(), length):
                own, start, number, trigger = phrases(pieces, length)
                digests = b"".join(
                    [
                        _digest(pieces[p][a : a + n + length - 1])
                        for p, a, n in zip(own.tolist(), start.tolist(), number.tolist(), strict=True)
                    ]
                )
                digests = np.frombuffer(digests, np.int64).reshape(-1, 2)
                row = np.array(rows, np.int64)[own]
                start = start + np.array(offsets, np.int64)[own]
                columns = [trigger.view(np.int64), digests[:, 0], digests[:, 1], ids[row], hashes[row], start, number]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _PARSE.replace(" long", "").split(", "))

    return docs.mapInArrow(run, _PARSE)


_PARSE = "trigger long, d1 long, d2 long, id long, hash long, start long, number long"


def _cut_out(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted phrases."""
    lists = wanted.groupBy("id", "hash").agg(
        F.collect_list(F.struct("trigger", "start", "number", "single", "frequent")).alias("phrases")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed", CHUNK_BYTES):
            rows = []
            keys = zip(batch.column("id").to_pylist(), batch.column("hash").to_pylist(), strict=True)
            for (id_, hash_), text, list_ in zip(keys, unpacked(batch), batch.column("phrases").to_pylist(), strict=True):
                for p in list_:
                    phrase = text[p["start"] : p["start"] + p["number"] + length - 1]
                    reach = _reach(phrase, length) if p["frequent"] else 0
                    rows.append((p["trigger"], id_, hash_, p["start"], p["single"], reach, phrase, p["frequent"]))
                if len(rows) > 4000:
                    yield _rows(rows, _CUT)
                    rows = []
            if rows:
                yield _rows(rows, _CUT)

    both = packed(docs).join(lists.hint("merge"), ["id", "hash"])
    return both.mapInArrow(run, _CUT)


_PHRASE = "trigger long, id long, hash long, start long, single boolean, reach long, bytes binary"
_CUT, _PARTS = f"{_PHRASE}, frequent boolean", f"{_PHRASE}, d1 long, d2 long"
_TYPES = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split(" ") for x in schema.split(", ")]
    arrays = [pa.array(x, _TYPES[t]) for x, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _reach(phrase: bytes, length: int) -> int:
    """Where the trigger of a phrase is."""
    hashes = _rolling(np.frombuffer(phrase[:length], np.uint8), _trigger_size(length))
    return int(((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)).argmin())


def parts(phrase: bytes, reach: int, width: int, length: int) -> Iterator[tuple[int, int, bytes]]:
    """Parts of a phrase whose stretches begin up to `width` places apart, at fixed distances before the trigger.

    reach: where the trigger is. For each part its least distance, first stretch, and the bytes that all stretches at
    such distances share, whatever phrase they are of: equal stretches are in parts that agree in these.
    """
    least = reach - (len(phrase) - length)
    for low in range(least // width * width, reach + 1, width):
        first = max(reach - low - width + 1, 0)
        yield low, first, phrase[reach - low : reach - low - width + 1 + length]


def _finer(cut: DataFrame, width: int, length: int) -> DataFrame:
    """Phrases in parts, each a phrase with another trigger: a digest of what its stretches share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", CHUNK_BYTES):
            rows = []
            for row in batch.to_pylist():
                phrase, reach = row["bytes"], row["reach"]
                for low, first, shared in parts(phrase, reach, width, length):
                    stop = min(reach - low, len(phrase) - length) + 1
                    part = phrase[first : stop + length - 1]
                    trigger = int.from_bytes(_digest(b"%d " % low + shared)[:8], "little", signed=True)
                    digest = np.frombuffer(_digest(part), np.int64).tolist()
                    rows.append((trigger, row["id"], row["hash"], row["start"] + first, row["single"], reach - first, part, *digest))
            yield _rows(rows, _PARTS)

    return cut.mapInArrow(run, _PARTS)


def _apart(cut: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """Phrases of frequent triggers, in parts of which few share a trigger; and spans of parts that are equal as a whole.

    Where very many phrases hold one passage, most parts are equal as a whole, or have nothing in common with others;
    only the few around an edge of the passage are cut again, at last into single stretches.
    """
    settled, spans = [cut.where("NOT frequent")], []
    many, width = cut.where("frequent"), length - _trigger_size(length) + 1
    key = ["trigger", "d1", "d2"]
    while width > 1 and not many.isEmpty():
        width = -(-width // PARTS)
        rows = written(_finer(many, width, length), "parts")
        one = F.struct("id", "hash", "start", "single", "reach", "bytes")
        dictionary = written(rows.groupBy(*key).agg(F.count("*").alias("n"), F.min(one).alias("one")), "dictionary")
        equal = dictionary.where("n > 1").select(*key)
        stop = F.col("start") + F.length("bytes") - length + 1
        spans.append(
            rows.where("single").join(equal.hint("merge"), key, "left_semi").select(
                "id", "hash", F.col("start").alias("first"), stop.cast("long").alias("stop")
            )
        )
        several = dictionary.groupBy("trigger").agg(F.count("*").alias("phrases")).where("phrases > 1")
        single = (F.col("one.single") & (F.col("n") == 1)).alias("single")
        cut = dictionary.join(written(several, "triggers").hint("merge"), "trigger").select(
            "trigger", "one.id", "one.hash", "one.start", single, "one.reach", "one.bytes", (F.col("phrases") > PHRASES).alias("frequent")
        )
        cut = written(cut, "phrases")
        settled.append(cut if width == 1 else cut.where("NOT frequent"))
        many = cut.where("frequent")
    return reduce(DataFrame.union, settled), spans


def repeated_suffixes(dictionary: list[bytes], length: int) -> list[np.ndarray]:
    """For each phrase, which of its suffixes begin with `length` bytes that another suffix begins with."""
    suffixes = [
        (phrase[at : at + length], number, at)
        for number, phrase in enumerate(dictionary)
        for at in range(len(phrase) - length + 1)
    ]
    suffixes.sort()
    out = [np.zeros(max(len(x) - length + 1, 0), bool) for x in dictionary]
    for (a, i, j), (b, k, m) in zip(suffixes, suffixes[1:], strict=False):
        if a == b:
            out[i][j] = out[k][m] = True
    return out


def _in_order(cut: DataFrame, length: int) -> DataFrame:
    """Repeats among the phrases of each trigger: first stretch and the one after the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def spans(group: list[tuple]) -> Iterator[tuple]:
            for (_, id_, hash_, start, single, *_), marks in zip(
                group, repeated_suffixes([x[5] for x in group], length), strict=True
            ):
                if single:
                    edges = np.flatnonzero(np.diff(marks.astype(np.int8), prepend=0, append=0))
                    for a, b in edges.reshape(-1, 2).tolist():
                        yield id_, hash_, start + a, start + b

        def given(groups: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
            found = [x for group in groups if len(group) > 1 for x in spans(group)]
            if found:
                arrays = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "hash", "first", "stop"])

        for batch in batches:
            groups: list[list[tuple]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    groups.append(held)
                    held = []
                held.append(row)
            yield from given(groups)
        yield from given([held])

    rows = cut.select("trigger", "id", "hash", "start", "single", "bytes").repartition("trigger").sortWithinPartitions("trigger")
    return rows.mapInArrow(run, "id long, hash long, first long, stop long")


def maximal_runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First byte and the one after the last of each run of bytes that spans cover; spans that touch are one run."""
    out: list[tuple[int, int]] = []
    for first, stop in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((first, stop))
    return out


def _removed(docs: DataFrame, spans: DataFrame, length: int, least_words: int) -> DataFrame:
    """Every text without the bytes of its repeats, after the other columns."""
    lists = spans.groupBy("id", "hash").agg(F.collect_set(F.struct("first", "stop")).alias("spans"))
    keys = [c for c in docs.columns if c != "text"]
    names = [*keys, "n_bytes", "n_removed", "n_spans", "kept"]
    schema = docs.select(*keys).schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept", "binary")):
        schema = schema.add(name, kind, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed", CHUNK_BYTES):
            results = []
            for text, list_ in zip(unpacked(batch), batch.column("spans").to_pylist(), strict=True):
                runs = maximal_runs([(x["first"], x["stop"] + length - 1) for x in list_ or ()])
                runs = [(i, j) for i, j in runs if not least_words or len(text[i:j].split()) >= least_words]
                edges = [0, *(edge for run in runs for edge in run), len(text)]
                kept = b"".join([text[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)])
                results.append((len(text), len(text) - len(kept), len(runs), kept))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(x, t) for x, t in zip(zip(*results, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keys), *columns], names)

    both = packed(docs).join(lists.hint("merge"), ["id", "hash"], "left")
    return both.select(*keys, "size", "packed", "spans").mapInArrow(run, schema)


def without_repeats(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    keep: list[str] | None = None,
    least_words: int = 0,
) -> DataFrame:
    """Removes every byte covered by a string of `length` bytes that also starts anywhere else.

    One row per input row: `doc_id`, or the columns to `keep`; `n_bytes`, `n_removed`, `n_spans` (maximal removed
    runs), `kept` (the remaining UTF-8 bytes). With `least_words`, maximal runs of fewer words stay. Strings are judged on the whole input, never cross texts, and may overlap; a
    repeat in the same text counts, and so does a repeated row, whose copies both lose it. A null text is
    empty; texts shorter than `length` stay as they are, longer ones are parsed in overlapping chunks. Null ids are
    kept, an empty table gives no rows. Other columns are ignored, whatever their names. Phrases are told apart by 128-bit digests.
    """
    keep = [doc_id] if keep is None else keep
    # Equal texts lose the same bytes, so rows that agree in both keys may share what is found for one.
    everything = documents.select(
        F.coalesce(column(doc_id).cast("long"), F.lit(-1)).alias("id"),
        F.xxhash64(column(text).cast("binary")).alias("hash"),
        *(column(c).alias(f"k{i}") for i, c in enumerate(keep)),
        column(text).cast("binary").alias("text"),
    )
    docs = everything.select("id", "hash", "text")

    parse = _parse(docs, length)
    # What is joined is written first: both sides of a join are then plain shuffles, whose hot keys can be split.
    triggers = parse.groupBy("trigger").agg(F.count("*").alias("n")).where("n > 1").select("trigger")
    with text_batches(documents.sparkSession):
        parse = written(parse.join(written(triggers, "triggers").hint("merge"), "trigger"), "parse")
    key = ["trigger", "d1", "d2"]
    dictionary = parse.groupBy(*key).agg(
        F.count("*").alias("n"), F.min(F.struct("id", "hash", "start", "number")).alias("one")
    )
    dictionary = written(dictionary, "dictionary")
    whole = parse.join(dictionary.where("n > 1").select(*key).hint("merge"), key, "left_semi").select(
        "id", "hash", F.col("start").alias("first"), (F.col("start") + F.col("number")).alias("stop")
    )
    several = dictionary.groupBy("trigger").agg(F.count("*").alias("phrases")).where("phrases > 1")
    several = written(several, "triggers")
    wanted = dictionary.join(several.hint("merge"), "trigger").select(
        "trigger", "one.*", (F.col("n") == 1).alias("single"), (F.col("phrases") > PHRASES).alias("frequent")
    )
    with text_batches(documents.sparkSession):
        cut = written(_cut_out(docs, wanted, length), "phrases")
        cut, equal = _apart(cut, length)
    spans = reduce(DataFrame.union, [whole, _in_order(cut, length), *equal])
    removed = _removed(everything, spans, length, least_words)
    return removed.drop("id", "hash").toDF(*keep, "n_bytes", "n_removed", "n_spans", "kept")


def digest(documents: DataFrame) -> DataFrame:
    """What is removed from every document, and SHA-256 of what is left."""
    return without_repeats(documents).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
