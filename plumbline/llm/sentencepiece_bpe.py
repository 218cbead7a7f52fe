"""SentencePiece BPE: words of a text merge side by side, all in flat arrays, round by round."""

from __future__ import annotations

import codecs
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.bpe import _cut, _ranges
from plumbline.llm.common import column, slices

SPACE = "▁"
_NONE = np.int32(2**31 - 1)
#: Words of more symbols than this merge by a queue, as rounds over one long word would cost its square.
ROUND_WIDTH = 1024
#: Words, and their letters, that a Python worker remembers between slices.
REMEMBERED, REMEMBERED_LETTERS = 200_000, 4_000_000

# Kinds of pieces, kinds of models, and the numbers of the fields read, in the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
MODEL_KIND, SPACE_LAST, BYTE_FALLBACK, UNK_ID, BOS_ID, EOS_ID, UNK_SURFACE = 3, 24, 35, 40, 41, 42, 44
CHARS_MAP, DUMMY_PREFIX, NO_EXTRA_SPACES, ESCAPE_SPACES = 2, 3, 4, 5


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("plumbline-each-byte", _each_byte)


class Model:
    """The pieces of a BPE model with byte fallback, and the pairs that make them."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        parts = [dict(_fields(v)) for k, v in message if k == PIECES]
        trainer = dict(f for k, v in message if k == TRAINER for f in _fields(v))
        rules = dict(f for k, v in message if k == NORMALIZER for f in _fields(v))
        self.texts = [p[PIECE_TEXT].decode() for p in parts]
        scores = np.array([struct.unpack("<f", p.get(PIECE_SCORE, bytes(4)))[0] for p in parts], np.float32)
        kinds = np.array([p.get(PIECE_KIND, NORMAL) for p in parts])
        plain = trainer.get(MODEL_KIND) == BPE and trainer.get(BYTE_FALLBACK, 0) and not trainer.get(SPACE_LAST, 0)
        plain = plain and not rules.get(CHARS_MAP) and rules.get(ESCAPE_SPACES, 1)
        if not plain or np.isin(kinds, (USER_DEFINED, UNUSED)).any():
            raise ValueError("only BPE models with byte fallback, plain pieces and no rules of normalisation")
        self.prefix = bool(rules.get(DUMMY_PREFIX, 1))
        self.squeeze = bool(rules.get(NO_EXTRA_SPACES, 1))
        self.unk, self.bos, self.eos = (
            _signed(trainer.get(k, default)) for k, default in ((UNK_ID, 0), (BOS_ID, 1), (EOS_ID, 2))
        )
        surface = trainer.get(UNK_SURFACE, " ⁇ ".encode())
        byte_ids = np.zeros(256, np.int32)
        shown = []
        for i, (text, kind) in enumerate(zip(self.texts, kinds.tolist(), strict=True)):
            if kind == BYTE:
                byte_ids[int(text[3:5], 16)] = i
                shown.append(bytes([int(text[3:5], 16)]))
            else:
                shown.append(b"" if kind == CONTROL else surface if kind == UNKNOWN else text.replace(SPACE, " ").encode())
        self.byte_ids = byte_ids
        self.lengths = np.array([len(x) for x in shown], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)
        self.silent = kinds == CONTROL
        self.leads = np.array([t.startswith(SPACE) for t in self.texts]) & (kinds == NORMAL)
        normal = {t: i for i, t in enumerate(self.texts) if kinds[i] == NORMAL}
        # A word ends where a blank follows another character, unless a piece reaches over such a place.
        over = any(regex.search(f"[^{SPACE}]{SPACE}", t) for t in normal)
        self.words = regex.compile(".+" if over else f"{SPACE}*[^{SPACE}]+|{SPACE}+", regex.DOTALL)
        # Characters that are no piece but part of one get numbers behind the pieces.
        inner = sorted({c for t in normal for c in t} - set(normal))
        self.size = len(parts)
        numbers = normal | {c: self.size + i for i, c in enumerate(inner)}
        self.of_char = np.full(0x110000, -1, np.int32)
        self.char_of = np.zeros(self.size + len(inner), np.int64)
        for text, i in numbers.items():
            if len(text) == 1:
                self.of_char[ord(text)] = i
                self.char_of[i] = ord(text)
        # Rank of a piece: best score first, pieces of one score share it.
        ranked, rank = np.unique(-scores, return_inverse=True)
        self.rank = rank.astype(np.int32)
        pairs = {
            (numbers[t[:cut]] << 32) | numbers[t[cut:]]: i
            for t, i in normal.items()
            for cut in range(1, len(t))
            if t[:cut] in numbers and t[cut:] in numbers
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        self.makes = np.array([pairs[k] for k in self.pairs.tolist()], np.int32)
        # Ranks after which a better or equal pair may arise, so that only the leftmost pair may merge in a round.
        self.unsafe = np.zeros(len(ranked), bool)
        made = self.rank[self.makes]
        self.unsafe[np.bincount(self.rank[np.unique(self.makes)], minlength=len(ranked)) > 1] = True
        for side in (self.pairs >> 32, self.pairs & 0xFFFFFFFF):
            known = side < self.size
            own = self.rank[side[known]]
            self.unsafe[own[made[known] <= own]] = True

    def made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece each pair makes, -1 if none."""
        keys = (left.astype(np.int64) << 32) | np.maximum(right, 0).astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where((self.pairs[at] == keys) & (left >= 0) & (right >= 0), self.makes[at], -1)

    def _ranks(self, made: np.ndarray) -> np.ndarray:
        return np.where(made >= 0, self.rank[made], _NONE)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, none of them empty.

        A round finds the best pair of every word and merges it wherever it stands in the word, from the left; if the
        new piece could be part of a better pair, only at the leftmost place. Words without a pair leave the arrays.
        """
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        # Symbols below zero stand for the character of number -2 - symbol, which no piece knows.
        symbols = self.of_char[chars].astype(np.int64)
        symbols = np.where(symbols < 0, -2 - chars, symbols)
        size = np.array([len(w) for w in words], np.int64)
        out: list[np.ndarray] = [None] * len(words)
        start = np.cumsum(size) - size
        for i in np.flatnonzero(size > ROUND_WIDTH):
            out[i] = self.merge_long(symbols[start[i] : start[i] + size[i]])
        index = np.flatnonzero(size <= ROUND_WIDTH)
        symbols, size = symbols[_ranges(start[index], size[index])], size[index]
        made = self._next(symbols, size)
        while len(index):
            start = np.cumsum(size) - size
            rank = self._ranks(made)
            best = np.minimum.reduceat(rank, start)
            over = best == _NONE
            if over.any():
                for i in np.flatnonzero(over):
                    out[index[i]] = symbols[start[i] : start[i] + size[i]]
                stay = np.repeat(~over, size)
                symbols, made, rank = symbols[stay], made[stay], rank[stay]
                index, size, best = index[~over], size[~over], best[~over]
                if not len(index):
                    break
            word = np.repeat(np.arange(len(index)), size)
            hits = np.flatnonzero(rank == best[word])
            new = np.diff(word[hits], prepend=-1) != 0
            run = np.cumsum(new | (np.diff(hits, prepend=-2) != 1))
            first = np.flatnonzero(np.diff(run, prepend=0))
            chosen = (np.arange(len(hits)) - first[run - 1]) % 2 == 0  # of hits side by side, every second one
            hits = hits[np.where(self.unsafe[best[word[hits]]], new, chosen)]
            symbols[hits] = made[hits]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            size = size - np.bincount(word[hits], minlength=len(index))
            symbols, made, word = symbols[keep], made[keep], word[keep]
            now = hits - np.arange(len(hits))
            for at in (now, now[now > 0] - 1):
                after = np.minimum(at + 1, len(symbols) - 1)
                inside = (at + 1 < len(symbols)) & (word[after] == word[at])
                made[at] = np.where(inside, self.made(symbols[at], symbols[after]), -1)
        return [self._spelled(s) for s in out]

    def _next(self, symbols: np.ndarray, size: np.ndarray) -> np.ndarray:
        """What each symbol makes with the next one of its word."""
        made = np.full(len(symbols), -1, np.int64)
        if len(symbols):
            made[:-1] = self.made(symbols[:-1], symbols[1:])
            made[np.cumsum(size) - 1] = -1
        return made

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same for one long word: the best pair, the leftmost of equals, is taken from a queue."""
        made = self._next(symbols, np.array([len(symbols)]))
        queue = [(r, i, m) for i, (r, m) in enumerate(zip(self._ranks(made).tolist(), made.tolist(), strict=True)) if m >= 0]
        heapq.heapify(queue)
        symbols, makes = symbols.tolist(), made.tolist()
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        table = dict(zip(self.pairs.tolist(), self.makes.tolist(), strict=True)) if queue else {}

        def pair(i: int) -> None:
            j = after[i]
            known = j >= 0 and symbols[i] >= 0 and symbols[j] >= 0
            makes[i] = m = table.get((symbols[i] << 32) | symbols[j], -1) if known else -1
            if m >= 0:
                heapq.heappush(queue, (int(self.rank[m]), i, m))

        while queue:
            _, i, m = heapq.heappop(queue)
            if makes[i] != m:
                continue  # one of the two has merged since
            j = after[i]
            symbols[i], symbols[j], makes[j] = m, None, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            pair(i)
            if before[i] >= 0:
                pair(before[i])
        return np.array([s for s in symbols if s is not None], np.int64)

    def _spelled(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of symbols: a character that is no piece becomes the ids of its bytes."""
        if len(symbols) == 0 or (symbols.min() >= 0 and symbols.max() < self.size):
            return symbols.astype(np.uint32)
        out = []
        for s in symbols.tolist():
            if 0 <= s < self.size:
                out.append(s)
            else:
                char = chr(self.char_of[s] if s >= 0 else -2 - s)
                out += self.byte_ids[np.frombuffer(char.encode(), np.uint8)].tolist()
        return np.array(out, np.uint32)

    def normalized(self, text: str) -> str:
        if self.squeeze:
            text = regex.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def decode(self, ids: np.ndarray, stops: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Texts of runs of ids that end at `stops`, as UTF-8, one after the other, and where each ends.

        The blank that begins the first piece shown is left out, as encoding put it there; bytes that are no
        UTF-8 become U+FFFD each.
        """
        starts, lengths, silent = self.starts[ids], self.lengths[ids], self.silent[ids]
        loud = np.flatnonzero(~silent)
        at = np.searchsorted(loud, np.concatenate([[0], stops[:-1]]))
        first = loud[at[at < len(loud)]]
        first = first[first < stops[at < len(loud)]]
        first = first[self.leads[ids[first]]] if self.prefix or self.squeeze else first[:0]
        starts[first] += 1
        lengths[first] -= 1
        flat = self.bytes[_ranges(starts, lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        # Ids that show nothing part the bytes beside them, as the ends of texts do.
        cuts = ends[np.union1d(stops, np.flatnonzero(silent) + 1)]
        data = flat.tobytes()
        inner = cuts[cuts < len(flat)]
        try:
            data.decode()
            apart = ((flat[inner] & 0xC0) != 0x80).all()
        except UnicodeDecodeError:
            apart = False
        if apart:
            return data, ends[stops]
        cuts = np.unique(cuts)
        parts = [data[a:b].decode("utf-8", "plumbline-each-byte").encode() for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
        now = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return b"".join(parts), now[np.searchsorted(np.concatenate([[0], cuts]), ends[stops])]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """Loaded once per Python worker."""
    return Model(path)


class _Codes(dict):
    def __missing__(self, word):
        self[word] = code = len(self)
        return code


class _Memory:
    """Words seen so far and their ids, one after the other in a flat array."""

    def __init__(self, model_: Model):
        self.model = model_
        self.codes, self.flat = _Codes(), np.zeros(0, np.uint32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        if len(self.codes) > REMEMBERED or len(self.flat) > REMEMBERED_LETTERS:
            self.__init__(self.model)
        known = len(self.codes)
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        if len(self.codes) > known:
            merged = self.model.encode_words(list(self.codes)[known:])
            lengths = np.fromiter(map(len, merged), np.int64, len(merged))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, *merged])
        lengths = self.lengths[codes]
        return self.flat[_ranges(self.starts[codes], lengths)], lengths


def encode(
    documents: DataFrame,
    keys: list[str],
    text: str,
    path: str,
    begin: bool = True,
    end: bool = True,
    decoded: bool = False,
) -> DataFrame:
    """Ids of every whole text: the key columns, `n_tokens`, `ids` and, if asked for, `decoded`.

    `ids` is binary, little-endian unsigned 32-bit, with the ids of begin and end if asked for; `decoded` holds the
    UTF-8 text the ids stand for. The model at `path`, in the public model format, is loaded on each worker; it
    must be a BPE model with byte fallback and without rules of normalisation. A null or empty text has no ids but
    those of begin and end, an empty table no rows; there is one row per input row, repeated rows included. A text of
    any length is encoded as a whole; other columns are ignored, whatever their names.
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
        m = model(path)
        memory = _Memory(m)
        for batch in slices(batches, "text"):
            words, ends = [], []
            for raw in batch.column("text").to_pylist():
                if raw:
                    words += m.words.findall(m.normalized(str(raw, "utf-8", "replace")))
                ends.append(len(words))
            ids, lengths = memory.ids(words)
            stops = np.concatenate([[0], np.cumsum(lengths)])[ends]
            ids, stops = _framed(ids, stops, m.bos if begin else -1, m.eos if end else -1)
            columns = [batch.column(s) for s in slots]
            columns += [pa.array(np.diff(stops, prepend=0)), _cut(ids.tobytes(), stops * 4)]
            if decoded:
                flat, where = m.decode(ids, stops)
                columns.append(_cut(flat, where))
            yield pa.RecordBatch.from_arrays(columns, [*slots, *outputs])

    return rows.mapInArrow(run, schema).toDF(*keys, *outputs)


def _framed(ids: np.ndarray, stops: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with those of begin and end (unless below zero) around every run."""
    starts = np.concatenate([[0], stops[:-1]])
    if begin >= 0 or end >= 0:
        at = np.concatenate([starts] * (begin >= 0) + [stops] * (end >= 0))
        what = np.concatenate([np.full(len(stops), x, np.uint32) for x in (begin, end) if x >= 0])
        # Of values that go to one place, the end of a run comes before the begin of the next.
        turn = np.concatenate([np.arange(len(stops)) * 2 + side for side, x in ((0, begin), (1, end)) if x >= 0])
        order = np.argsort(turn, kind="stable")
        ids = np.insert(ids, at[order], what[order])
        stops = stops + np.arange(1, len(stops) + 1) * ((begin >= 0) + (end >= 0))
    return ids.astype(np.uint32), stops


def digests(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """The key columns, `n_tokens`, and SHA-256 of the ids and of the decoded text."""
    return encoded.select(
        *map(column, keys),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
