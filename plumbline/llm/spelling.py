"""Spelling variants: words one letter apart, found as equal pairs of trie nodes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, slices, written
from plumbline.llm.shingles import mixed

#: Different words that a task holds before it hands its counts on.
HELD_WORDS = 300_000
#: Trie nodes that a task numbers at once (of one word at least).
NODES = 1 << 18
#: Doublings that follow every chain of forms: each form occurs at least twice as often as its word, and counts have 63 bits.
DOUBLINGS = 6

# Letters are A-Z, a-z and U+00C0 to U+00FF; these are their UTF-8 bytes, A-Z in lower case.
_LETTERS = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
_SEEDS = np.random.default_rng(13_1).integers(0, 2**64, (2, 256), np.uint64)


def _slipped(word: bytes, hash_: int) -> bytes:
    """The word without the letter that the hash names."""
    letters = str(word, "utf-8")
    at = hash_ % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(documents: DataFrame, doc_id: str, text: str, least_letters: int, slip: int | None) -> DataFrame:
    """`word` and `n`, how often it occurs in all texts; words of too few letters are left out."""
    rows = documents.select(
        F.coalesce(column(doc_id).cast("string"), F.lit("")).alias("id"), column(text).cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            # A letter takes one or two bytes; two-byte letters begin with C3.
            kept = {w: n for w, n in counts.items() if len(w) - w.count(b"\xc3") >= least_letters}
            counts.clear()
            words = pa.array(kept.keys(), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(kept.values(), pa.int64())], ["word", "n"])

        for batch in slices(batches, "text"):
            for id_, raw in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = Counter(_LETTERS.findall(raw.lower())) if raw else {}
                if slip is not None:
                    start = crc32(f"{id_}:".encode())
                    for word in [w for w in own if crc32(w, start) % slip == 0]:
                        counts[_slipped(word, crc32(word, start))] += own.pop(word)
                for word, n in own.items():
                    counts[word] += n
                if len(counts) > HELD_WORDS:
                    yield counted()
        yield counted()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _numbered(letters: np.ndarray, size: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Numbers of the trie nodes on the path of each word, root first, size + 1 of them; words lie one after the other.

    A node's number is a 64-bit digest of its path, so the same prefix has the same number in every task.
    """
    stops = np.cumsum(size)
    first = stops - size
    out = np.empty(len(letters) + len(size), np.uint64)
    base = first + np.arange(len(size))  # place of each root
    node = np.full(len(size), seeds[0], np.uint64)
    out[base] = node
    on = np.argsort(-size, kind="stable")
    lengths = size[on]
    for depth in range(int(lengths[0]) if len(lengths) else 0):
        on = on[: np.searchsorted(-lengths, -depth, side="left")]
        node[on] = mixed(node[on] ^ seeds[letters[first[on] + depth]])
        out[base[on] + depth + 1] = node[on]
    return out


def _pairs(letters: np.ndarray, size: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix node, suffix node, what) of words with a position skipped, and of words with one inserted.

    `what` is id * 4 + 0 for an insertion, 1 for a skipped letter, 2 for one that begins a run of equal letters.
    """
    whole = size + 1
    start = np.cumsum(whole) - whole
    forward = _numbered(letters, size, _SEEDS[0])
    first = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(first, size)
    turned = letters[np.repeat(first + size - 1, size) - place]
    backward = _numbered(turned, size, _SEEDS[1])
    # The suffix behind position i of a word of n letters is the path of its last n - i letters.
    at = np.arange(len(forward)) - np.repeat(start, whole)
    suffix = backward[np.repeat(start + size, whole) - at]
    skip = np.flatnonzero(at < np.repeat(size, whole))
    run = np.ones(len(letters), np.int64)
    run[1:] += (letters[1:] != letters[:-1]) | (place[1:] == 0)
    run[:1] = 2
    return (
        np.concatenate([forward, forward[skip]]),
        np.concatenate([suffix, suffix[skip + 1]]),
        np.concatenate([np.repeat(ids, whole) * 4, np.repeat(ids, size) * 4 + run]),
    )


def _dictionary(words: DataFrame) -> DataFrame:
    """`prefix`, `suffix`, `what`: all pairs of trie nodes of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", NODES):
            texts = batch.column("word").to_pylist()
            size = np.array([len(x) for x in texts], np.int64)
            letters = np.frombuffer("".join(texts).encode("latin-1"), np.uint8)
            prefix, suffix, what = _pairs(letters, size, batch.column("id").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefix.view(np.int64)), pa.array(suffix.view(np.int64)), pa.array(what)],
                ["prefix", "suffix", "what"],
            )

    return words.select("id", "word").mapInArrow(run, "prefix long, suffix long, what long")


def _met(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From sorted rows (prefix, suffix, what) of whole groups: id, number of near words met, the least id among them.

    A group is one string with one place in it: the word that is this string, if there is one, and the words with one
    letter more there, which differ from each other in this letter alone, so that a group is no larger than the alphabet.
    """
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1
    rows, group = rows[many], np.unique(group[many], return_inverse=True)[1]
    none = np.iinfo(np.int64).max
    ids, kind = rows[:, 2] >> 2, rows[:, 2] & 3
    groups = int(group[-1]) + 1 if len(group) else 0

    def least(of: np.ndarray) -> np.ndarray:
        out = np.full(groups, none)
        np.minimum.at(out, group[of], ids[of])
        return out

    longer, short, head = kind > 0, kind == 0, kind == 2
    size = np.bincount(group[longer], minlength=groups)
    heads = np.bincount(group[head], minlength=groups)
    first = least(longer)
    second = least(longer & (ids != first[group]))
    shorter, headed = least(short), least(head)
    # A word with a letter more meets all others of its kind, and the shorter word once for each run of equal letters.
    others = np.where(ids == first[group], second[group], first[group])
    meets = head & (shorter[group] != none)
    near = np.where(longer, size[group] - 1 + meets, heads[group])
    best = np.where(longer, np.minimum(others, np.where(meets, shorter[group], none)), headed[group])
    some = near > 0
    return ids[some], near[some], best[some]


def _neighbours(pairs: DataFrame) -> DataFrame:
    """`id`, `n_near` and `best`, the least id among the near words; words without near words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _met(rows)], ["id", "n_near", "best"])

        rest = np.zeros((0, 3), np.int64)
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy() for c in ("prefix", "suffix", "what")])
            rows = np.concatenate([rest, rows])
            if not len(rows):
                continue
            # The last group may go on in the next batch.
            last = len(rows) - int(np.argmin((rows[::-1, :2] == rows[-1, :2]).all(axis=1)))
            cut = 0 if (rows[:, :2] == rows[-1, :2]).all() else last
            if cut:
                yield out(rows[:cut])
            rest = rows[cut:]
        if len(rest):
            yield out(rest)

    sorted_ = pairs.repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix")
    met = sorted_.mapInArrow(run, "id long, n_near long, best long")
    return met.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def spelling_variants(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_letters: int = 6,
    least_n: int = 5,
    factor: int = 5,
    slip: int | None = 199,
) -> DataFrame:
    """Words and the much more frequent word one letter away that each may be a variant of.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z as a-z. With `slip`, a run whose CRC-32 of
    "<doc_id>:<run>" it divides loses the letter that this hash names. Words of at least `least_letters` letters and
    `least_n` occurrences count. Near are words that differ by one letter inserted, deleted or replaced; a
    word's form is its near word of most occurrences (ties: the first in code point order), if those are at least
    `factor` (two or more) times its own.

    Returns word, form (null if none), root (the end of the chain of forms; the word itself if none), n, n_near and
    form_n. Null and empty texts hold no words, a null id stands for the empty text, repeated rows count as often as
    they occur, an empty table gives no rows, texts and words of any length are read to the end; other columns are
    ignored, whatever their names.

    Words are numbered by falling occurrences, so that the best near word is the one with the least number. Nodes of
    the tries of all words, read forward and backward, are numbered by 64-bit digests of their paths. A word gives a
    pair of nodes (its prefix, its suffix) for every letter skipped and for every place between letters; equal
    pairs, compared by 128 bits, are words one letter apart. Their groups are no larger than the alphabet.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, or forms could go in circles")
    counts = word_counts(documents, doc_id, text, least_letters, slip).where(F.col("n") >= least_n)
    words = written(
        counts.orderBy(F.desc("n"), "word").withColumn("id", F.monotonically_increasing_id()), "words"
    )
    near = _neighbours(_dictionary(words))
    formed = words.join(near, "id", "left")
    best = words.select(F.col("id").alias("best"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    is_form = F.col("near_n") >= F.lit(factor) * F.col("n")
    formed = written(
        formed.join(best, "best", "left").select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best")).alias("to"),
            F.when(is_form, F.col("near_word")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    steps = formed.where("to IS NOT NULL").select("id", "to")
    for _ in range(DOUBLINGS):  # each step goes as far as two of the last
        further = steps.select(F.col("id").alias("to"), F.col("to").alias("further"))
        steps = written(steps.join(further, "to", "left").select("id", F.coalesce("further", "to").alias("to")), "steps")
    ends = words.select(F.col("id").alias("to"), F.col("word").alias("root"))
    roots = steps.join(ends, "to").select("id", "root")
    return formed.join(roots, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The same in DuckDB's SQL: CRC-32 byte by byte, near words by the strings left without a letter.
ORACLE_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
         ELSE a >> 1 END, b::BIGINT) ORDER BY b) AS t FROM range(256) r(b)),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce([('0x' || x[2 * i - 1:2 * i])::BIGINT FOR i IN range(1, length(x) // 2 + 1)],
         lambda a, b: xor(crc.t[(xor(a, b) & 255) + 1], a >> 8), 4294967295::BIGINT), 4294967295) AS h
  FROM bytes, crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n
    FROM hashed)
  GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5),
cut AS (
  SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cut.word, w.word FROM cut JOIN words w ON w.word = cut.rest
  UNION SELECT w.word, cut.word FROM cut JOIN words w ON w.word = cut.rest),
best AS (
  SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, other, w.n AS other_n
  FROM near JOIN words w ON w.word = other
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other) = 1),
formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * words.n THEN other END AS form,
         CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word),
chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT chain.word, formed.word, formed.form FROM chain JOIN formed ON formed.word = chain.next)
SELECT formed.word, form, root, n, n_near, form_n
FROM formed JOIN chain ON chain.word = formed.word AND chain.next IS NULL
"""
