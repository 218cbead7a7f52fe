"""Class-conditional Kneser-Ney models of words, letter by letter.

A word is read with a start and an end mark. Each letter is predicted from up to four before it (fewer
at the start of a word) by counts of the class; what they leave over goes to counts that all classes
share: in how many longer contexts the last three letters occur. All counts are exact, of every text;
runs of letters are known by 64-bit hashes. Counts that fit in memory make a model that is sent to the
tasks; larger ones stay where they are and are joined with the words of the texts.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices, unpacked, written

#: Letters of context; letters of the shorter context that classes share.
CONTEXT, SHORT = 4, 2
DISCOUNT = 0.75
#: Probability of a letter of which nothing is known, and least of one that classes share.
FLOOR, LEAST = 1 / 256, 1e-3 / 256
#: Numbers that a model may hold to be sent to every task, 4 bytes each; beyond that words are scored by joins.
MODEL_CELLS = 1 << 25
#: Runs of letters that a task counts before it hands its counts on.
HELD_GRAMS = 1 << 20
#: Different words that a task holds, so as not to take them apart in each slice anew.
HELD_WORDS = 1 << 16

# Word characters without decimal digits; among them are other numbers, such as fractions and superscripts.
_WORD = re.compile(r"[^\W\d_]+")
_NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_WORD_AMONG_NUMBERS = re.compile(rf"[^\W\d_{_NUMBERS}]+")
_START, _END = "\x02", "\x03"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

KEYS = ["gram", "context", "short", "short_context"]
COUNT_SCHEMA = "class int, extra boolean, gram long, context long, short long, short_context long, n long"


def word_pattern(text: str) -> re.Pattern:
    """What finds the runs of letters of a lower-cased text; the exact pattern is slow, and seldom needed."""
    return _WORD if "".join(_WORD.findall(text)).isalpha() else _WORD_AMONG_NUMBERS


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    if not text:
        return []
    found = _WORD.findall(text := text.lower())
    return found if "".join(found).isalpha() else _WORD_AMONG_NUMBERS.findall(text)


class Codes(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word):
        self[word] = code = len(self)
        return code


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return (h ^ (h >> np.uint64(32))).view(np.int64)


class Grams:
    """For each letter of each word, and its end: hashes of the letter in context, of its context, and shorter ones."""

    def __init__(self, unique: list[str]):
        text = "".join([f"{_START}{w}{_END}" for w in unique])
        letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.fromiter(map(len, unique), np.int64, len(unique)) + 2
        word = np.repeat(np.arange(len(unique)), lengths)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        hashes = letters * _MIX  # of the last letter; then of the last two, and so on, up to the start
        full = hashes.copy()
        kept: dict[int, np.ndarray] = {1: full.copy()}
        power = np.uint64(1)
        for size in range(2, CONTEXT + 2):
            with np.errstate(over="ignore"):
                power = power * _BASE
                full[size - 1 :] += np.where(place[size - 1 :] >= size - 1, hashes[: -(size - 1)] * power, np.uint64(0))
            kept[size] = full.copy()
        at = np.flatnonzero(place > 0)
        self.word = word[at]
        with np.errstate(over="ignore"):
            self.gram = _mixed(kept[CONTEXT + 1][at])
            self.context = _mixed(kept[CONTEXT][at - 1] + np.uint64(1))
            self.short = _mixed(kept[SHORT + 1][at])
            self.short_context = _mixed(kept[SHORT][at - 1] + np.uint64(1))


def count_grams(rows: DataFrame, extra=None) -> DataFrame:
    """Counts of every gram for each class, over whole texts; rows: `class` int, and `text` or packed texts.

    `class`, the keys of a gram and `n`. Each task adds up what it has read before anything is shuffled.
    `extra(words, times)` may give further counts, which come back with `extra` set and their number as
    `gram`. Null texts and classes are skipped. The rows are written.
    """

    source = "text" if "text" in rows.columns else "packed"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], int] = {}
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def summed(parts: list[np.ndarray]) -> np.ndarray:
            """Grams of a class, each once, in rows of its keys and its number."""
            lines = np.concatenate(parts, axis=1)
            gram, first, place = np.unique(lines[0], return_index=True, return_inverse=True)
            n = np.bincount(place, lines[4], len(gram)).astype(np.int64)
            return np.stack([gram, *lines[1:4, first], n])

        by_class: dict[int, Codes] = {}
        times: dict[int, np.ndarray] = {}

        def taken_apart() -> Iterator[pa.RecordBatch]:
            """Adds the grams of the words so far; hands on those held where they are too many."""
            nonlocal held, size
            for label, codes in by_class.items():
                if not codes:
                    continue
                unique, often = list(codes), times[label]
                g = Grams(unique)
                lines = summed([np.stack([g.gram, g.context, g.short, g.short_context, often[g.word]])])
                held.setdefault(label, []).append(lines)
                size += lines.shape[1]
                for key, n in (extra(unique, often) if extra else {}).items():
                    totals[label, key] = totals.get((label, key), 0) + int(n)
            by_class.clear()
            times.clear()
            if size > HELD_GRAMS:
                for label, parts in held.items():
                    held[label] = [summed(parts)]
                size = sum(lines[0].shape[1] for lines in held.values())
                if size > HELD_GRAMS * 3 // 4:  # hardly anything came together
                    for label, (lines,) in held.items():
                        yield _count_batch(label, False, lines)
                    held, size = {}, 0

        for batch in slices(batches, source):
            if source == "text":
                texts = batch.column("text").to_pylist()
            else:
                texts = [str(x, "utf-8", "replace") for x in unpacked(batch)]
            coded: dict[int, list[np.ndarray]] = {}
            for label, text in zip(batch.column("class").to_pylist(), texts, strict=True):
                if label is None or not text:
                    continue
                codes = by_class.setdefault(label, Codes())
                found = words(text)
                coded.setdefault(label, []).append(np.fromiter(map(codes.__getitem__, found), np.int32, len(found)))
            for label, some in coded.items():
                often = np.bincount(np.concatenate(some), minlength=len(by_class[label]))
                before = times.get(label, often[:0])
                often[: len(before)] += before
                times[label] = often
            if sum(map(len, by_class.values())) > HELD_WORDS:
                yield from taken_apart()
        yield from taken_apart()
        for label, parts in held.items():
            yield _count_batch(label, False, summed(parts))
        for (label, key), n in totals.items():
            yield _count_batch(label, True, np.array([[key], [0], [0], [0], [n]]))

    counts = rows.mapInArrow(run, COUNT_SCHEMA).groupBy("class", "extra", "gram")
    return written(counts.agg(*(F.max(c).alias(c) for c in KEYS[1:]), F.sum("n").alias("n")), "grams")


def _count_batch(label: int, extra: bool, lines: np.ndarray) -> pa.RecordBatch:
    own = [pa.array(np.full(lines.shape[1], label), pa.int32()), pa.array(np.full(lines.shape[1], extra))]
    return pa.RecordBatch.from_arrays([*own, *(pa.array(x, pa.int64()) for x in lines)], ["class", "extra", *KEYS, "n"])


def _find(sorted_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted array, -1 for those that are not there."""
    if not len(sorted_):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)
    return np.where(sorted_[at] == keys, at, -1)


class WordModel:
    """Log-probabilities of words under each class, made from counts that are collected."""

    def __init__(self, counts: pa.Table, groups: list[list[int]]):
        """groups: for each class of the model, the classes of the counts that it adds up; others are left out."""
        column = {name: counts.column(name).to_numpy() for name in ("class", *KEYS, "n")}
        some = np.isin(column["class"], [c for group in groups for c in group])
        column = {name: x[some] for name, x in column.items()}
        self.grams, first, place = np.unique(column["gram"], return_index=True, return_inverse=True)
        count = np.stack(
            [np.bincount(place, column["n"] * np.isin(column["class"], group), len(self.grams)) for group in groups], axis=1
        )
        self.contexts, context = np.unique(column["context"][first], return_inverse=True)
        self.total, self.types = (
            np.stack([np.bincount(context, x[:, j], len(self.contexts)) for j in range(len(groups))], axis=1)
            for x in (count, count > 0)
        )
        self.shorts, of_short, short = np.unique(column["short"][first], return_index=True, return_inverse=True)
        self.longer = np.bincount(short, minlength=len(self.shorts))  # longer contexts of three letters
        self.short_contexts, back = np.unique(column["short_context"][first][of_short], return_inverse=True)
        self.short_total = np.bincount(back, self.longer, len(self.short_contexts))
        self.short_types = np.bincount(back, minlength=len(self.short_contexts))
        shared = self._shared(short, _find(self.short_contexts, column["short_context"][first]))
        self.logs = self._logs(count, context, shared).astype(np.float32)

    def _shared(self, short: np.ndarray, short_context: np.ndarray) -> np.ndarray:
        if not len(self.shorts):
            return np.full(len(short), FLOOR)
        longer = np.where(short >= 0, self.longer[short], 0)
        total, types = self.short_total[short_context], self.short_types[short_context]
        shared = (np.maximum(longer - DISCOUNT, 0) + DISCOUNT * types * FLOOR) / np.maximum(total, 1)
        return np.where(short_context >= 0, np.maximum(shared, LEAST), FLOOR)

    def _logs(self, count: np.ndarray, context: np.ndarray, shared: np.ndarray) -> np.ndarray:
        if not len(self.contexts):
            return np.repeat(np.log(shared)[:, None], count.shape[1], axis=1)
        total = np.where(context[:, None] >= 0, self.total[context], 0)
        own = np.maximum(count - DISCOUNT, 0) + DISCOUNT * np.maximum(self.types[context], 1) * shared[:, None]
        return np.log(np.where(total > 0, own / np.maximum(total, 1), shared[:, None]))

    def log_probabilities(self, unique: list[str]) -> np.ndarray:
        """One row per word, one column per class."""
        classes = self.logs.shape[1]
        if not unique:
            return np.zeros((0, classes), np.float32)
        g = Grams(unique)
        place = _find(self.grams, g.gram)
        logs = np.empty((len(place), classes), np.float32)
        known = place >= 0
        logs[known] = self.logs[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            shared = self._shared(_find(self.shorts, g.short[new]), _find(self.short_contexts, g.short_context[new]))
            logs[new] = self._logs(np.zeros((len(new), classes)), _find(self.contexts, g.context[new]), shared)
        return np.add.reduceat(logs, np.flatnonzero(np.diff(g.word, prepend=-1)), axis=0)


class JoinedModel:
    """The same from counts too many to be sent anywhere: texts are joined with the scores of their words."""

    def __init__(self, counts: DataFrame, groups: list[list[int]]):
        self.classes = len(groups)
        known = counts.where(F.col("class").isin([c for group in groups for c in group]))
        sums = (F.sum(F.when(F.col("class").isin(g), F.col("n")).otherwise(0)).alias(f"c{j}") for j, g in enumerate(groups))
        grams = written(known.groupBy("gram").agg(*sums, *(F.max(c).alias(c) for c in KEYS[1:])), "grams")
        self.grams = grams.select("gram", *(f"c{j}" for j in range(self.classes)))
        self.contexts = grams.groupBy("context").agg(
            *(F.sum(f"c{j}").alias(f"t{j}") for j in range(self.classes)),
            *(F.count_if(F.col(f"c{j}") > 0).alias(f"y{j}") for j in range(self.classes)),
        )
        shorts = grams.groupBy("short").agg(F.count("*").alias("longer"), F.max("short_context").alias("short_context"))
        self.shorts = shorts.select("short", "longer")
        self.short_contexts = shorts.groupBy("short_context").agg(F.sum("longer").alias("total"), F.count("*").alias("types"))

    def with_scores(self, rows: DataFrame, text: str = "text") -> DataFrame:
        """The rows with `known`, the words of their text and the scores of each."""
        marks = [F.xxhash64(text).alias("m1"), F.xxhash64(F.lit("text"), text).alias("m2")]
        marked = rows.select("*", *marks)

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                lists = [sorted(set(words(x))) for x in batch.column("text").to_pylist()]
                own = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
                columns = [batch.column("m1").take(own), batch.column("m2").take(own)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([w for x in lists for w in x], pa.string())], ["m1", "m2", "word"])

        def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    g = Grams(batch.column("word").to_pylist())
                    columns = [batch.column("word").take(pa.array(g.word)), *(pa.array(getattr(g, k)) for k in KEYS)]
                    yield pa.RecordBatch.from_arrays(columns, ["word", *KEYS])

        of_texts = marked.select("m1", "m2", F.col(text).alias("text")).where("text IS NOT NULL")
        of_texts = written(of_texts.mapInArrow(found, "m1 long, m2 long, word string").distinct(), "words")
        places = of_texts.select("word").distinct().mapInArrow(letters, "word string, " + ", ".join(f"{k} long" for k in KEYS))
        for table, key in ((self.grams, "gram"), (self.contexts, "context"), (self.shorts, "short"), (self.short_contexts, "short_context")):
            places = places.join(table.hint("merge"), key, "left")
        shared = (
            f"if(total IS NULL, {FLOOR!r}D, greatest({LEAST!r}D, (greatest(coalesce(longer, 0L) - {DISCOUNT}D, 0D)"
            f" + {DISCOUNT}D * types * {FLOOR!r}D) / total))"
        )
        own = (
            f"(greatest(coalesce(c{j}, 0L) - {DISCOUNT}D, 0D) + {DISCOUNT}D * greatest(y{j}, 1L) * shared) / t{j}"
            for j in range(self.classes)
        )
        logs = (f"ln(if(t{j} > 0, {p}, shared)) AS p{j}" for j, p in enumerate(own))
        scored = places.selectExpr("*", f"{shared} AS shared").selectExpr("word", *logs).groupBy("word")
        scored = scored.agg(F.array(*(F.sum(f"p{j}") for j in range(self.classes))).alias("scores"))
        known = of_texts.join(scored.hint("merge"), "word").groupBy("m1", "m2")
        known = known.agg(F.collect_list(F.struct("word", "scores")).alias("known"))
        return marked.join(known.hint("merge"), ["m1", "m2"], "left").drop("m1", "m2")


def fitted(counts: DataFrame, groups: list[list[int]]) -> WordModel | JoinedModel:
    """The model of some counts, in memory if it has at most MODEL_CELLS numbers."""
    counts = counts.where("NOT extra")
    if counts.count() * len(groups) <= MODEL_CELLS:
        return WordModel(counts.toArrow(), groups)
    return JoinedModel(counts, groups)


class Scorer:
    """Rows to score, prepared for either kind of model, and the scores of words inside tasks."""

    def __init__(self, model: WordModel | JoinedModel, rows: DataFrame):
        """rows: with a column `text`."""
        self.joined = isinstance(model, JoinedModel)
        self.rows = model.with_scores(rows) if self.joined else rows
        self.shared = None if self.joined else rows.sparkSession.sparkContext.broadcast(model)
        self.classes = model.classes if self.joined else model.logs.shape[1]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "rows"}

    def log_probabilities(self, batch: pa.RecordBatch, unique: list[str]) -> np.ndarray:
        """Scores of all words of the texts of a batch, one row each."""
        if not self.joined:
            return self.shared.value.log_probabilities(unique)
        known = {w["word"]: w["scores"] for row in batch.column("known").to_pylist() for w in row or ()}
        return np.array([known[w] for w in unique], np.float64).reshape(len(unique), self.classes)
