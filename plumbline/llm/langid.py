"""Language of texts and of the spans in them: scripts, word scores, Viterbi."""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import column, slices
from plumbline.llm.wordmodel import Codes, Scorer, count_grams, fitted, word_pattern, words

#: First code point of each range and its script; ranges end where the next one starts.
_SCRIPT_RANGES = [
    (0x0000, ""),
    (0x0041, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0700, ""),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"),
    (0x0B80, "Tamil"),
    (0x0C00, "Telugu"),
    (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"),
    (0x0E00, "Thai"),
    (0x0E80, "Lao"),
    (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Ethiopic"),
    (0x13A0, ""),
    (0x1780, "Khmer"),
    (0x1800, "Mongolian"),
    (0x18B0, ""),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, ""),
    (0x3040, "Kana"),
    (0x3100, ""),
    (0x31F0, "Kana"),
    (0x3200, ""),
    (0x3400, "Han"),
    (0xA000, ""),
    (0xAC00, "Hangul"),
    (0xD7B0, ""),
    (0xF900, "Han"),
    (0xFB00, ""),
    (0x20000, "Han"),
    (0x32000, ""),
]
_SPANS = T.ArrayType(T.StructType().add("lang", "string").add("start", "integer").add("end", "integer"))
_STARTS = [start for start, _ in _SCRIPT_RANGES]
SCRIPTS = sorted({script for _, script in _SCRIPT_RANGES})
_SCRIPT_OF = [SCRIPTS.index(script) for _, script in _SCRIPT_RANGES]
#: Share of a language's own letters that a script needs for the language to be a candidate for its words.
CANDIDATE_SHARE = 0.002
#: What a change of language costs, and how far one word may speak against a language, in nats.
SWITCH, WORD_LIMIT = 12.0, 10.0
#: Different words whose scores a task remembers.
REMEMBERED = 1 << 18


def script(word: str) -> int:
    """The script of a word's first letter."""
    return _SCRIPT_OF[bisect.bisect_right(_STARTS, ord(word[0])) - 1]


def _letters_by_script(unique: list[str], times: np.ndarray) -> dict[int, int]:
    """Letters of each script."""
    size = np.fromiter(map(len, unique), np.int64, len(unique)) * times
    sums = np.bincount(np.fromiter(map(script, unique), np.int64, len(unique)), size, len(SCRIPTS))
    return {s: int(n) for s, n in enumerate(sums) if n}


class LanguageModel:
    """Scores of the words of each language, and the languages each script may stand for."""

    def __init__(self, languages: list[str], counts: DataFrame):
        self.languages = languages
        self.words = fitted(counts, [[i] for i in range(len(languages))] or [[]])
        letters = counts.where("extra").toArrow()
        by_script = np.zeros((len(SCRIPTS), len(languages)))
        np.add.at(by_script, tuple(letters.column(c).to_numpy() for c in ("gram", "class")), letters.column("n").to_numpy())
        self.prior = by_script.sum(axis=0) / max(by_script.sum(), 1)
        # Of its own letters, so that a language is no less a candidate where others have far more text.
        fair = by_script / np.maximum(by_script.sum(axis=0), 1) >= CANDIDATE_SHARE
        self.candidates = fair | ~fair.any(axis=1, keepdims=True)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "words"}  # sent to tasks by itself

    def scores(self, unique: list[str], logs: np.ndarray) -> np.ndarray:
        """Log-likelihood of each word in each language, best 0; what a script rules out is at the limit."""
        logs = logs.astype(np.float64)
        allowed = self.candidates[np.fromiter(map(script, unique), np.int64, len(unique))]
        logs[~allowed] = -np.inf
        return np.maximum(logs - logs.max(axis=1, keepdims=True), -WORD_LIMIT) if len(logs) else logs

    def one_language(self, scores: np.ndarray) -> bool:
        """Whether no stretch of a text gains more by another language than a change costs."""
        gain = np.cumsum(scores - scores[:, [scores.sum(axis=0).argmax()]], axis=0)
        gain = np.vstack([np.zeros(gain.shape[1]), gain])
        return (gain - np.minimum.accumulate(gain, axis=0)).max() <= SWITCH


def viterbi(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The best language of each word of each text, all texts a word at a time; each text: words x languages."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order])
    starts = np.cumsum(lengths) - lengths
    scores = np.concatenate([texts[i] for i in order])
    n, k = len(order), scores.shape[1]
    came = np.empty((len(scores), k), np.int16)
    state = scores[starts]
    own = np.arange(k, dtype=np.int16)
    for t in range(1, lengths[0]):
        m = int(np.searchsorted(-lengths, -t))  # texts longer than t come first
        before = state[:m]
        best = before.argmax(axis=1)
        other = before[np.arange(m), best] - SWITCH
        stay = before >= other[:, None]
        at = starts[:m] + t
        came[at] = np.where(stay, own, best[:, None])
        state[:m] = np.where(stay, before, other[:, None]) + scores[at]
    path = np.empty(len(scores), np.int16)
    now = state.argmax(axis=1)
    for t in range(lengths[0] - 1, -1, -1):
        m = int(np.searchsorted(-lengths, -t)) if t else n
        at = starts[:m] + t
        path[at] = now[:m]
        if t:
            now[:m] = came[at, now[:m]]
    out: list[np.ndarray] = [None] * n
    for j, i in enumerate(order):
        out[i] = path[starts[j] : starts[j] + lengths[j]]
    return out


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", learn: Column | None = None) -> LanguageModel:
    """Counts all rows with a language for which `learn` holds (a condition on the columns of documents).

    Null texts and null languages teach nothing; repeated rows count again. The languages must be few
    (labels, not free text): they are collected.
    """
    rows = documents.where(F.lit(True) if learn is None else learn).select(
        column(text).alias("text"), column(lang).cast("string").alias("lang")
    )
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1 if languages else F.lit(None)
    counts = count_grams(rows.select(number.cast("int").alias("class"), "text"), _letters_by_script)
    return LanguageModel(languages, counts)


def identify(documents: DataFrame, model: LanguageModel, keys: list[str], text: str = "text") -> DataFrame:
    """Language of every whole text and of its spans: key columns, `lang_pred`, `score`, `spans`.

    `spans` lists lang, start and end (code points of the lower-cased text, end exclusive) of each
    stretch of words in one language. `lang_pred` is the language of most letters; `score` the share of
    letters in it, times its probability against one other language throughout. A null text, one
    without letters, and any text under a model that has learnt no language get `und`, 0 and no spans.
    On equal letters the language that sorts first wins. One row per input row, repeated rows included, none for
    an empty table; texts of any length are read whole. Other columns are ignored, whatever their names.
    """
    slots = [f"k{i}" for i in range(len(keys))]
    rows = documents.select(*(column(c).alias(s) for c, s in zip(keys, slots, strict=True)), column(text).alias("text"))
    outputs = ["lang_pred", "score", "spans"]
    span = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = rows.drop("text").schema.add("lang_pred", "string", False).add("score", "double", False)
    schema = schema.add("spans", _SPANS, False)
    scorer = Scorer(model.words, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words(len(model.languages))
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            predicted = list(_identified(model, scorer, batch, known)) if model.languages else [("und", 0.0, [])] * len(texts)
            lang, score, spans = (list(x) for x in zip(*predicted, strict=True))
            columns = [batch.column(s) for s in slots]
            columns += [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(columns, [*slots, *outputs])

    return scorer.rows.mapInArrow(run, schema).toDF(*keys, *outputs)


class _Words:
    """The words that a task has met, with their letters and scores, so that each is scored once."""

    def __init__(self, languages: int):
        self.codes, self.size, self.scores = Codes(), np.zeros(0, np.int64), np.zeros((0, languages))

    def renew(self) -> None:
        if len(self.codes) > REMEMBERED:
            self.__init__(self.scores.shape[1])

    def scored(self, model: LanguageModel, scorer: Scorer, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Letters and scores of all words by code; words without scores are in texts of the batch."""
        fresh = list(islice(self.codes, len(self.size), None))
        if fresh:
            self.size = np.concatenate([self.size, np.fromiter(map(len, fresh), np.int64, len(fresh))])
            self.scores = np.concatenate([self.scores, model.scores(fresh, scorer.log_probabilities(batch, fresh))])
        return self.size, self.scores


def _identified(
    model: LanguageModel, scorer: Scorer, batch: pa.RecordBatch, known: _Words
) -> Iterator[tuple[str, float, list]]:
    texts = batch.column("text").to_pylist()
    known.renew()
    coded, first_words = [], []
    for text in texts:
        found = words(text)
        first_words.append(found[0] if found else "")
        coded.append(np.fromiter(map(known.codes.__getitem__, found), np.int32, len(found)))
    size, scores = known.scored(model, scorer, batch)
    mixed = {i: scores[x] for i, x in enumerate(coded) if len(x) and not model.one_language(scores[x])}
    paths = dict(zip(mixed, viterbi(list(mixed.values())), strict=True)) if mixed else {}
    for i, (text, x) in enumerate(zip(texts, coded, strict=True)):
        if not len(x):
            yield "und", 0.0, []
            continue
        total = scores[x].sum(axis=0) + 1e-9 * model.prior
        if i not in paths:
            best, share = int(total.argmax()), 1.0
            low = text.lower()
            first, last = low.find(first_words[i]), len(low)  # letters before the first word would be a word
            spans = [{"lang": model.languages[best], "start": first, "end": last}]
        else:
            letters = np.bincount(paths[i], size[x], len(model.languages))
            best = int(letters.argmax())
            share = float(letters[best] / letters.sum())
            spans = _spans(model, text, paths[i])
        chance = 1 / np.exp(np.minimum(total - total[best], 700)).sum()
        yield model.languages[best], share * float(chance if i not in paths else 1.0), spans


def _spans(model: LanguageModel, text: str, path: np.ndarray) -> list[dict]:
    starts = np.flatnonzero(np.r_[True, np.diff(path) != 0])
    low = text.lower()
    found = [(m.start(), m.end()) for m in word_pattern(low).finditer(low)]
    ends = np.r_[starts[1:], len(path)] - 1
    return [
        {"lang": model.languages[path[a]], "start": found[a][0], "end": found[b][1]}
        for a, b in zip(starts, ends, strict=True)
    ]


def digest(documents: DataFrame) -> DataFrame:
    """Languages learnt outside every fourth document: doc_id, held_out, lang_pred, score, n_spans."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(documents, learn=F.coalesce(~held_out, F.lit(True)))
    found = identify(documents, model, ["doc_id"])
    return found.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        F.size("spans").cast("long").alias("n_spans"),
    )
