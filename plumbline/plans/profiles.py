"""A store of profiles: each batch is profiled once, and the whole is scored without reading old batches again."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import scoring
from plumbline.functions.rules import Rules
from plumbline.functions.values import quoted
from plumbline.operators.partials import Profile, counts, counts_and_total, merge, profile
from plumbline.plans.scorecard import kpis, score

# The folders of a store, and the columns it adds: a digest of the batch label, and the write a row came from.
CELLS, TEXTS, KEYS = "cells", "texts", "keys"
LABEL_KEY, RUN = "_batch_key", "_run"


def save_profile(p: Profile, path: str) -> None:
    """Adds a profile with one batch column to a store; batches that are there already are replaced.

    Text values and keys go into folders of this write; which write holds for a batch is said by the table of cells,
    written last and a batch at a time. So a write that fails leaves the store as it was, and a
    replayed batch counts once.
    """
    if len(p.by) != 1:
        raise ValueError("a store holds profiles with one batch column")
    run = f"of_{uuid.uuid4().hex}"
    label = F.col(quoted(p.by[0])).cast("string")
    key = F.when(label.isNull(), "none").otherwise(F.concat(F.lit("of_"), F.sha2(label, 256)))
    for part in (TEXTS, KEYS):
        p.parts()[part].withColumn(LABEL_KEY, key).write.parquet(f"{path}/{part}/{RUN}={run}")
    (
        p.cells.withColumn(LABEL_KEY, key)
        .withColumn(RUN, F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LABEL_KEY)
        .parquet(f"{path}/{CELLS}")
    )


def append_profile(
    df: DataFrame,
    path: str,
    batch: str = "batch_date",
    key: str | None = None,
    rules: Rules | None = None,
    row_id: str | None = None,
) -> None:
    """Profiles the rows of each value of `batch` and adds them to the store."""
    save_profile(profile(df, key, rules, row_id, [batch]), path)


def read_profile(spark: SparkSession, path: str, batch: str = "batch_date") -> Profile:
    """All batches of a store, as they were written last."""
    cells = spark.read.parquet(f"{path}/{CELLS}")
    live = cells.select(LABEL_KEY, RUN).distinct()
    # A row per batch; what other writes left behind falls out here.
    parts = {
        part: spark.read.parquet(f"{path}/{part}").join(live, [LABEL_KEY, RUN], "left_semi")
        for part in (TEXTS, KEYS)
    }
    parts[CELLS] = cells
    if batch not in cells.columns:
        raise ValueError(f"no such batch column: {batch}")
    return Profile(**{part: rows.drop(LABEL_KEY, RUN) for part, rows in parts.items()}, by=(batch,))


def merge_batches(spark: SparkSession, path: str, target: str, label: str, batch: str = "batch_date") -> None:
    """All batches of a store as one batch of the store `target`, named `label`: a shorter store with the same total."""
    p = merge(read_profile(spark, path, batch))
    name = F.lit(label).cast(_label_type(spark, path, batch)).alias(batch)
    save_profile(Profile(*(rows.select("*", name) for rows in (p.cells, p.texts, p.keys)), by=(batch,)), target)


def _label_type(spark: SparkSession, path: str, batch: str) -> T.DataType:
    return spark.read.parquet(f"{path}/{CELLS}").schema[batch].dataType


def _merged_counts(spark: SparkSession, path: str, batch: str, labels: Sequence | None) -> DataFrame:
    p = read_profile(spark, path, batch)
    if labels is not None:
        wanted = F.col(quoted(batch)).isin(list(labels))
        p = Profile(*(rows.where(wanted) for rows in (p.cells, p.texts, p.keys)), by=p.by)
    return counts(merge(p))


def merged_scorecard(
    spark: SparkSession,
    path: str,
    batch: str = "batch_date",
    labels: Sequence | None = None,
    weights: Mapping[str, int] = scoring.WEIGHTS,
) -> DataFrame:
    """The scorecard of all rows of all batches of a store (of those with `labels`), from their profiles alone.

    Keys and casings that occur in several batches count as in one table. A column that some batches lack is scored
    over the others.
    """
    return score(_merged_counts(spark, path, batch, labels), weights=weights)


def merged_summary(
    spark: SparkSession,
    path: str,
    batch: str = "batch_date",
    labels: Sequence | None = None,
    weights: Mapping[str, int] = scoring.WEIGHTS,
) -> DataFrame:
    """The KPIs of all rows of all batches of a store."""
    return kpis(_merged_counts(spark, path, batch, labels), weights=weights)


def scorecard_with_total(
    df: DataFrame,
    key: str | None = None,
    rules: Rules | None = None,
    row_id: str | None = None,
    by: Sequence[str] = (),
    weights: Mapping[str, int] = scoring.WEIGHTS,
) -> DataFrame:
    """The scorecard of every batch and, marked `is_total`, of all of them, from one profile of the table."""
    return score(counts_and_total(profile(df, key, rules, row_id, by)), ["is_total", *by], weights)
