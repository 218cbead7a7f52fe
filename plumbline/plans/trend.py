"""Quality over time: a history of batch scores, its trend, drift and breaches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions import scoring
from plumbline.functions.values import quoted


# Partition column of a history: a digest of the label, which names its folder.
LABEL_KEY = "_batch_key"


def append_history(scores: DataFrame, path: str, batch: str = "batch_date") -> None:
    """Write scores that carry a `batch` column into the history.

    Re-running a batch replaces its own rows and no others.  The label itself is
    an ordinary column and keeps its type and spelling, missing ones included.
    """
    label = F.col(quoted(batch)).cast("string")
    key = F.when(label.isNull(), "none").otherwise(F.concat(F.lit("of_"), F.sha2(label, 256)))
    (
        scores.withColumn(LABEL_KEY, key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LABEL_KEY)
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a history, as they were appended."""
    return spark.read.parquet(path).drop(LABEL_KEY)


def quality_trend(spark: SparkSession, path: str, batch: str = "batch_date") -> DataFrame:
    """The recorded overall score of every batch, oldest first."""
    label = F.col(quoted(batch))
    return read_history(spark, path).select(label, "overall_health_score").orderBy(label)


def score_drift(
    history: DataFrame,
    score: str = "overall_health_score",
    batch: str = "batch_date",
    per: str | None = None,
) -> DataFrame:
    """Each batch's score beside the previous batch's.

    `per` names the column that tells the score series apart (for a history of
    scorecards, "column").  A series has one row per batch.
    """
    series = [per] if per is not None else []
    order = W.partitionBy(*series).orderBy(batch)
    change = F.expr(scoring.as_hundredths(score))
    return history.select(
        *series,
        batch,
        score,
        F.lag(score).over(order).alias("previous_score"),
        ((change - F.lag(change).over(order)) / F.lit(100.0)).alias("score_change"),
    )


def breaches(scores: DataFrame, threshold: float, score: str = "health_score") -> DataFrame:
    """Columns or batches whose score is below `threshold`."""
    return scores.where(F.col(score) < threshold)


def new_breaches(
    history: DataFrame,
    threshold: float,
    score: str = "health_score",
    batch: str = "batch_date",
    per: str | None = "column",
) -> DataFrame:
    """The breaches that an alert is for: a score below `threshold` whose series was not below it one batch before.

    `per` names the column that tells the series apart (None: one series); a series that begins below the
    threshold is a new breach as well.  `previous_score` is that of the batch before, null if there is none.
    """
    series = [per] if per is not None else []
    order = W.partitionBy(*series).orderBy(batch)
    seen = history.withColumn("previous_score", F.lag(score).over(order))
    return seen.where((F.col(score) < threshold) & F.coalesce(F.col("previous_score") >= threshold, F.lit(True)))
