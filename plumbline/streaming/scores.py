"""Scoring a stream batch by batch, and as a whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from plumbline.functions import scoring
from plumbline.functions.rules import Rules
from plumbline.functions.values import quoted
from plumbline.operators.partials import profile
from plumbline.operators.profile import COUNTS, column_counts
from plumbline.plans.profiles import save_profile
from plumbline.plans.scorecard import kpis, score
from plumbline.plans.trend import append_history, read_history
from plumbline.streaming.seen import NEW_KEY, new_keys, with_new_keys


def _counts_of_new(
    held: DataFrame, key: str, rules: Rules | None, row_id: str | None, by: Sequence[str]
) -> DataFrame:
    """Counts of a micro-batch whose keys were told new or not by the stream's state."""
    counts = column_counts(held.where(f"NOT {NEW_KEY}").drop(NEW_KEY), None, rules, row_id, by)
    names = [quoted(c) for c in by]
    is_key = F.col("column") == F.lit(key)
    others = [c for c in COUNTS if c != "duplicate_keys"]
    rows = counts.withColumn("duplicate_keys", F.when(is_key, F.col("total")).otherwise(F.lit(0).cast("long")))
    place = [f for f in held.columns if f not in (NEW_KEY, row_id, *by)].index(key)
    new = held.where(NEW_KEY).select(
        *names,
        F.lit(place).alias("ordinal"),
        F.lit(key).alias("column"),
        *(F.lit(0).cast("long").alias(c) for c in others),
        F.lit(-1).cast("long").alias("duplicate_keys"),
    )
    return rows.unionByName(new).groupBy(*names, "ordinal", "column").agg(*(F.sum(c).alias(c) for c in COUNTS))


def score_stream(
    stream: DataFrame,
    history: str,
    checkpoint: str,
    key: str | None = None,
    rules: Rules | None = None,
    weights: Mapping[str, int] = scoring.WEIGHTS,
    row_id: str | None = None,
    by: Sequence[str] = (),
    seen_within: str | None = None,
    time: str | None = None,
) -> DataStreamWriter:
    """A writer, still to be started, that scores every micro-batch.

    `<history>/summary` gets the KPIs, `<history>/scorecard` the column scores and `<history>/counts` what they were
    made of, all keyed by batch_id: a replayed batch replaces its rows.  `row_id` is not scored; `by` scores parts
    of a micro-batch apart.  A batch is read from its source once and kept while it is scored.

    Without `seen_within`, batches share no state: a key that returns in a later batch is no duplicate.  With it
    ("30 days"), it is one if the stream has had it within that time, by the clock or by the column `time`; so is
    one that comes too late to be judged, see `new_keys`.  Case variants across batches are not seen; `profile_stream` sees them.
    """
    source = stream
    if seen_within is not None:
        if key is None:
            raise ValueError("seen_within needs a key")
        source = with_new_keys(stream, new_keys(stream, key, seen_within, time, row_id, by))

    def record(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        counts = None
        try:
            if seen_within is None:
                counts = column_counts(held, key, rules, row_id, by).persist()
            elif held.isEmpty():  # a batch without rows, run for the state's sake
                return
            else:
                counts = _counts_of_new(held, key, rules, row_id, by).persist()
            tagged = F.lit(batch_id).cast("long").alias("batch_id")
            append_history(counts.select(tagged, "*"), f"{history}/counts", "batch_id")
            append_history(kpis(counts, by, weights).select(tagged, "*"), f"{history}/summary", "batch_id")
            append_history(score(counts, by, weights).select(tagged, "*"), f"{history}/scorecard", "batch_id")
        finally:
            if counts is not None:
                counts.unpersist()
            held.unpersist()

    return source.writeStream.foreachBatch(record).option("checkpointLocation", checkpoint)


def stream_history(spark: SparkSession, history: str, part: str = "summary") -> DataFrame:
    """What `score_stream` has recorded so far: the "summary", "scorecard" or "counts" rows."""
    return read_history(spark, f"{history}/{part}")


def stream_scorecard(
    spark: SparkSession, history: str, by: Sequence[str] = (), weights: Mapping[str, int] = scoring.WEIGHTS
) -> DataFrame:
    """The scorecard of all that `score_stream` has read so far, from the counts of its batches.

    Keys that return count if the stream was scored with `seen_within`; casings count within their batch.
    """
    names = [quoted(c) for c in by]
    counts = stream_history(spark, history, "counts").groupBy(*names, "ordinal", "column")
    return score(counts.agg(*(F.sum(c).alias(c) for c in COUNTS)), by, weights)


def profile_stream(
    stream: DataFrame,
    store: str,
    checkpoint: str,
    key: str | None = None,
    rules: Rules | None = None,
    row_id: str | None = None,
) -> DataStreamWriter:
    """A writer, still to be started, that adds the profile of every micro-batch to a store, under its batch_id.

    `merged_scorecard(spark, store, "batch_id")` then scores all rows of the stream as one table, keys and casings
    of different batches included, without reading them again.  A replayed batch replaces its profile.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        held = batch.withColumn("batch_id", F.lit(batch_id).cast("long")).persist()
        try:
            save_profile(profile(held, key, rules, row_id, ["batch_id"]), store)
        finally:
            held.unpersist()

    return stream.writeStream.foreachBatch(record).option("checkpointLocation", checkpoint)
