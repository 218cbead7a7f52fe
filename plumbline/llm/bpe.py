"""Byte-level BPE: pieces in padded matrices, one bucket per length, merged row by row in rounds."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, slices

_NONE = np.int32(2**31 - 1)
_EMPTY = np.int64(-1)
_SLOT_BITS = 21
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Rows up to this many symbols merge one pair a round; in longer ones every occurrence of the pair merges at once.
ONE_MERGE_WIDTH = 64
#: Pieces whose ids a Python worker remembers between slices.
REMEMBERED = 200_000


class Vocabulary:
    """Ranks of a byte-level BPE and the pairs that make its tokens, the latter in an open-addressed table."""

    def __init__(self, path: str, pattern: str):
        self.pattern = regex.compile(pattern)
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        pairs = {
            (left << 32) | right: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        }
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        #: Tokens that, once merged, can form a pair of a lower rank than their own.
        self.unsafe = np.zeros(size, bool)
        for side in (keys >> 32, keys & 0xFFFFFFFF):
            self.unsafe[side[values < side]] = True
        self.slot_keys = np.full(1 << _SLOT_BITS, _EMPTY)
        self.slot_values = np.full(1 << _SLOT_BITS, _NONE)
        at, left = self._slots(keys), np.arange(len(keys))
        while len(left):  # each round every free slot takes one of the keys that ask for it
            free = self.slot_keys[at[left]] == _EMPTY
            self.slot_keys[at[left[free]]] = keys[left[free]]
            done = self.slot_keys[at[left]] == keys[left]
            self.slot_values[at[left[done]]] = values[left[done]]
            left = left[~done]
            at[left] = (at[left] + 1) & ((1 << _SLOT_BITS) - 1)

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair merges to; _NONE where it makes no token or a side is padding (-1)."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        at = self._slots(keys)
        found = self.slot_keys[at]
        out = np.where(found == keys, self.slot_values[at], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != _EMPTY) & (keys >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << _SLOT_BITS) - 1)
            found = self.slot_keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_values[at[open_[hit]]]
            open_ = open_[~hit & (found != _EMPTY)]
        return out

    def merge(self, symbols: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of a matrix of byte ids, all rows of one length."""
        rows, width = symbols.shape
        out: list[np.ndarray] = [None] * rows
        index = np.arange(rows)
        ranks = np.full((rows, width), _NONE)
        ranks[:, :-1] = self.pair_ranks(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(rows, width - 1)
        while len(index):
            at = ranks.argmin(axis=1)  # the leftmost of the lowest
            row = np.arange(len(index))
            lowest = ranks[row, at]
            over = lowest == _NONE
            if over.any():
                for i in np.flatnonzero(over):
                    out[index[i]] = symbols[i][symbols[i] >= 0]
                keep = ~over
                index, symbols, ranks, at, lowest = index[keep], symbols[keep], ranks[keep], at[keep], lowest[keep]
                if not len(index):
                    break
                row = np.arange(len(index))
            width = symbols.shape[1]
            shift = np.arange(width) + (np.arange(width) > at[:, None])
            np.minimum(shift, width - 1, out=shift)
            symbols = np.take_along_axis(symbols, shift, 1)
            ranks = np.take_along_axis(ranks, shift, 1)
            symbols[:, -1] = -1
            ranks[:, -1] = _NONE
            symbols[row, at] = lowest
            symbols, ranks = symbols[:, : width - 1], ranks[:, : width - 1]  # compaction: every row lost one symbol
            width -= 1
            after = np.minimum(at + 1, width - 1)
            ranks[row, at] = self.pair_ranks(lowest, np.where(at + 1 < width, symbols[row, after], -1))
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.pair_ranks(symbols[before, at[before] - 1], lowest[before])
        return out

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of one long piece: each round merges, from the left, every occurrence of the lowest pair.

        That equals one merge at a time unless the new token can form a lower pair; then only the leftmost merges.
        """
        ranks = self.pair_ranks(symbols[:-1], symbols[1:])
        while len(ranks) and (lowest := ranks.min()) != _NONE:
            hits = np.flatnonzero(ranks == lowest)
            if self.unsafe[lowest]:
                hits = hits[:1]
            elif len(hits) > 1 and (np.diff(hits) == 1).any():  # of hits side by side, every second one
                run = np.r_[0, np.cumsum(np.diff(hits) != 1)]
                first = np.flatnonzero(np.r_[True, np.diff(run) != 0])
                hits = hits[(np.arange(len(hits)) - first[run]) % 2 == 0]
            symbols[hits] = lowest
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            symbols = symbols[keep]
            kept_ranks = np.append(ranks, _NONE)[keep]
            now = hits - np.arange(len(hits))
            for at in (now, now - 1):
                at = at[at >= 0]
                right = np.where(at + 1 < len(symbols), symbols[np.minimum(at + 1, len(symbols) - 1)], -1)
                kept_ranks[at] = self.pair_ranks(symbols[at], right)
            ranks = kept_ranks[:-1]
        return symbols

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; one that is a token itself is that token."""
        out: list[np.ndarray] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (rank := self.ranks.get(piece)) is not None:
                out[i] = np.array([rank], np.int32)
            else:
                buckets.setdefault(len(piece), []).append(i)
        for width, members in buckets.items():
            if width > ONE_MERGE_WIDTH:
                for i in members:
                    out[i] = self.merge_long(self.byte_ids[np.frombuffer(pieces[i], np.uint8)])
                continue
            flat = np.frombuffer(b"".join([pieces[i] for i in members]), np.uint8)
            merged = self.merge(self.byte_ids[flat].reshape(len(members), width))
            for i, ids in zip(members, merged, strict=True):
                out[i] = ids
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and how many each id has."""
        lengths = self.lengths[ids]
        return self.bytes[_ranges(self.starts[ids], lengths)], lengths


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] of them), starts[1], ..."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - before, lengths)


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Loaded once per Python worker."""
    return Vocabulary(path, pattern)


class _Codes(dict):
    def __missing__(self, piece):
        self[piece] = code = len(self)
        return code


class _Memory:
    """Pieces seen so far and their ids, one after the other in a flat array."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.codes, self.flat = _Codes(), np.zeros(0, np.uint32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each piece has."""
        if len(self.codes) > REMEMBERED:
            self.__init__(self.vocab)
        known = len(self.codes)
        codes = np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces))
        if len(self.codes) > known:
            fresh = list(self.codes)[known:]
            merged = self.vocab.encode_pieces([x.encode() for x in fresh])
            lengths = np.fromiter(map(len, merged), np.int64, len(merged))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, *merged]).astype(np.uint32)
        lengths = self.lengths[codes]
        return self.flat[_ranges(self.starts[codes], lengths)], lengths


def encode(documents: DataFrame, keys: list[str], text: str, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """Token ids of every whole text: the key columns, `n_tokens`, `ids` and, if asked for, `decoded`.

    `ids` is binary, little-endian unsigned 32-bit; `decoded` holds the bytes those ids stand for. The
    vocabulary at `path` (base64 token and rank per line, all 256 bytes among them) is loaded on each
    worker; `pattern` cuts a text into the pieces that merge separately. A null or empty text has no ids.
    One row per input row, repeated rows included, none for an empty table; texts of any length are encoded
    whole. Other columns are ignored, whatever their names.
    """
    slots = [f"k{i}" for i in range(len(keys))]
    rows = documents.select(
        *(column(c).alias(s) for c, s in zip(keys, slots, strict=True)), column(text).cast("binary").alias("text")
    )
    outputs = ["n_tokens", "ids", *["decoded"] * decoded]
    schema = rows.drop("text").schema.add("n_tokens", "long", False).add("ids", "binary", False)
    if decoded:
        schema = schema.add("decoded", "binary", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        memory = _Memory(vocab)
        for batch in slices(batches, "text", 2 << 20):
            pieces, ends = [], []
            for raw in batch.column("text").to_pylist():
                if raw:
                    pieces += vocab.pattern.findall(str(raw, "utf-8", "replace"))
                ends.append(len(pieces))
            ids, lengths = memory.ids(pieces)
            stops = np.concatenate([[0], np.cumsum(lengths)])[ends]
            columns = [batch.column(s) for s in slots]
            columns += [pa.array(np.diff(stops, prepend=0)), _cut(ids.tobytes(), stops * 4)]
            if decoded:
                flat, sizes = vocab.decode(ids)
                columns.append(_cut(flat.tobytes(), np.concatenate([[0], np.cumsum(sizes)])[stops]))
            yield pa.RecordBatch.from_arrays(columns, [*slots, *outputs])

    return rows.mapInArrow(run, schema).toDF(*keys, *outputs)


def _cut(flat: bytes, stops: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], stops]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def digests(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """The key columns, `n_tokens`, and SHA-256 of the ids and of the decoded bytes."""
    return encoded.select(
        *map(column, keys),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
