"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary texts.

A text's score compares its log-likelihoods under both, divided by its length: of the whole text, with
repeated words counted less, and of the few words that tell most, so that a short expression is not lost
in a long text. A logistic curve over these quotients turns them into a score from 0 to 1; it is fitted
on labelled rows that the models of its own features have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, packed, slices
from plumbline.llm.wordmodel import Codes, JoinedModel, Scorer, WordModel, count_grams, fitted, words

#: Labelled rows the logistic curve is fitted on, at most; taken in the order of a hash of their features.
CURVE_ROWS = 50_000
_FEATURES = ("mean", "damped", "telling")
#: Words of a text that the last of them is about.
TELLING = 3


def _ratios(difference: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[float, float, float]:
    """Differences of log-likelihoods: per letter; over the root of the letters, repeated words counted less; and
    per word of the different words that speak most for the second class, TELLING of them or all that there are.
    """
    if not len(codes):
        return 0.0, 0.0, 0.0
    unique, times = np.unique(codes, return_counts=True)
    gain, letters = difference[unique], size[unique]
    weight = 1 + np.log(times)
    telling = np.sort(gain)[-TELLING:].mean()
    return float(gain @ times / (letters @ times)), float(gain @ weight / np.sqrt(letters @ weight)), float(telling)


def _features(documents: DataFrame, keys: list[str], text: str, model: WordModel | JoinedModel) -> DataFrame:
    """The quotients of every whole text, after the key columns (k0, k1, ...)."""
    slots = [f"k{i}" for i in range(len(keys))]
    rows = documents.select(*(column(c).alias(s) for c, s in zip(keys, slots, strict=True)), column(text).alias("text"))
    schema = rows.drop("text").schema
    for name in _FEATURES:
        schema = schema.add(name, "double", False)
    scorer = Scorer(model, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes = Codes()
            texts = []
            for text in batch.column("text").to_pylist():
                found = words(text)
                texts.append(np.fromiter(map(codes.__getitem__, found), np.int32, len(found)))
            unique = list(codes)
            size = np.fromiter(map(len, unique), np.float64, len(unique)) + 1
            logs = scorer.log_probabilities(batch, unique)
            difference = (logs[:, 1] - logs[:, 0]).astype(np.float64)
            values = zip(*(_ratios(difference, size, x) for x in texts), strict=True)
            columns = [batch.column(s) for s in slots] + [pa.array(x, pa.float64()) for x in values]
            yield pa.RecordBatch.from_arrays(columns, [*slots, *_FEATURES])

    return scorer.rows.mapInArrow(run, schema)


def _curve(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic curve, by Newton's method with a slight ridge."""
    centre, spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    inputs = np.c_[(features - centre) / spread, np.ones(len(features))]
    weights, ridge = np.zeros(inputs.shape[1]), np.diag([0.1] * features.shape[1] + [1e-6])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (chance - labels) + ridge @ weights
        bend = (inputs.T * (chance * (1 - chance) + 1e-9)) @ inputs + ridge
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    scaled = weights[:-1] / spread
    return scaled, float(weights[-1] - scaled @ centre)


def score(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    learn: Column | None = None,
    curve: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Toxicity of every whole text: `doc_id`, or the columns to `keep`, and `score` from 0 to 1, higher for label 1.

    Learns from the rows of `labels` for which `learn` holds (a condition on the column `doc_id`; all
    rows if not given). Those for which `curve` holds too (by default a fifth, by a hash of the id) fit
    the logistic curve with features of a model that leaves them out; the score itself uses a model of
    all. Labels that are null, or neither 0 nor 1, and labels without a document teach nothing; a repeated
    label counts again. With labels of one class only, or none, every score is the share of ones,
    (ones + 1) / (rows + 2). Null and empty texts are scored like a text without evidence, very long ones as a whole. One row per
    document row, repeated rows and null ids included; other columns are ignored, whatever their names.
    """
    keep = [doc_id] if keep is None else keep
    key = F.col("doc_id")
    learn = F.lit(True) if learn is None else learn
    curve = F.pmod(F.xxhash64(key), F.lit(5)) == 0 if curve is None else curve
    told = (
        labels.select(column(doc_id).alias("doc_id"), column(label).cast("int").alias("label"))
        .where(learn & F.col("label").isin(0, 1))
        .withColumn("part", curve.cast("int"))
    )
    texts = documents.select(column(doc_id).alias("doc_id"), column(text).alias("text")).where(learn)
    # Labels are few per document but grow with the corpus: the join is never a broadcast, at any size.
    rows = packed(texts).join(told.hint("merge"), "doc_id")
    rows = rows.select((F.col("label") * 2 + F.col("part")).alias("class"), "size", "packed")
    counts = count_grams(rows)

    ones = told.agg(F.sum("label").alias("ones"), F.count("*").alias("rows")).first()
    share = ((ones["ones"] or 0) + 1) / (ones["rows"] + 2)
    if not {0, 2} <= {r[0] for r in counts.select("class").distinct().collect()}:
        return documents.select(*map(column, keep), F.lit(share).alias("score"))

    known = (
        _features(texts.where(curve), ["doc_id"], "text", fitted(counts, [[0], [2]]))
        .join(told.where("part = 1").hint("merge"), F.col("k0") == key)
        .select(*_FEATURES, "label")
        .orderBy(F.xxhash64(*_FEATURES))
        .limit(CURVE_ROWS)
        .toPandas()
        .to_numpy(np.float64)
    )
    if len(np.unique(known[:, -1])) < 2:  # the curve needs both classes; without them the ratio itself decides
        slopes, offset = np.array([10.0, 0.0, 0.0]), 0.0
    else:
        slopes, offset = _curve(known[:, :-1], known[:, -1])
    power = sum((F.col(name) * float(slope) for name, slope in zip(_FEATURES, slopes, strict=True)), F.lit(offset))
    chance = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), power))))
    scored = _features(documents, keep, text, fitted(counts, [[0, 1], [2, 3]])).withColumn("score", chance)
    return scored.drop(*_FEATURES).toDF(*keep, "score")


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores learnt outside every fifth document: doc_id, held_out, score, predicted."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    scored = score(documents, labels, learn=fold != 0, curve=fold == 4)
    return scored.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
