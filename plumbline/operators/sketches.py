"""Approximate key uniqueness from HyperLogLog sketches: a few kilobytes per batch, which merge over any history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scoring
from plumbline.functions.values import key_text, quoted
from plumbline.operators.table import Table

# Binary logarithm of a sketch's registers.
LG_K = 12

# Standard error of a merged sketch times the square root of its registers, and how many of them the margin is.
_ERROR = 1.04
DEVIATIONS = 3


def margin(lg_k: int = LG_K) -> float:
    """The stated relative error of a number of distinct keys: three standard errors (99.7 % of cases)."""
    return DEVIATIONS * _ERROR / 2 ** (lg_k / 2)


def key_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """Per batch and column: `total` rows, `missing` ones, and a `sketch` of the values that are there.

    One aggregate that combines in each task, so the shuffle has a row per task and batch, whatever the number of
    keys. Append the rows to a history, and `approximate_uniqueness` answers for any of its batches together.
    """
    t = Table(df, by=by)
    fields = [t.field(c) for c in columns]
    absent = [c for c, f in zip(columns, fields, strict=True) if f is None]
    if absent:
        raise ValueError(f"no such column: {', '.join(absent)}")
    values = t.df.select(*t.by_refs, *(f.comparable("key_sketches").alias(f.ref) for f in fields))
    texts = values.selectExpr(*t.by_refs, *(f"{key_text(f.ref, f.dtype)} AS {f.ref}" for f in fields))
    wide = texts.groupBy(*t.by_refs).agg(
        F.count("*").alias("total"),
        *(F.expr(f"count_if({f.ref} IS NULL) AS missing_{f.ref}") for f in fields),
        *(F.expr(f"hll_sketch_agg({f.ref}, {int(lg_k)}) AS sketch_{f.ref}") for f in fields),
    )
    rows = ", ".join(
        f"struct({f.ordinal} AS ordinal, total, missing_{f.ref} AS missing, sketch_{f.ref} AS sketch)" for f in fields
    )
    return t.named(
        wide.selectExpr(*t.by_refs, f"inline(array({rows}))").select(
            *t.by_refs, t.column_name(), "total", "missing", "sketch"
        )
    )


def approximate_uniqueness(sketches: DataFrame, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """Per column, over all batches of `sketches` (per value of `by`): what `key_uniqueness` counts, estimated.

    Missing keys are one key, counted exactly. `margin` is how many duplicates the count may be off, three standard
    errors of sketches of 2^lg_k registers; the exact count stays the default everywhere else.
    """
    groups = sketches.groupBy(*(quoted(c) for c in by), "column").agg(
        F.sum("total").alias("total"),
        F.sum("missing").alias("missing"),
        F.expr("coalesce(hll_sketch_estimate(hll_union_agg(sketch, true)), 0L)").alias("present"),
    )
    distinct = "least(present + if(missing > 0, 1L, 0L), total)"
    repeats = groups.selectExpr("*", f"total - {distinct} AS repeats", f"CAST(ceil(present * {margin(lg_k)}) AS BIGINT) AS margin")
    return repeats.selectExpr(
        *(quoted(c) for c in by),
        "`column`",
        "total AS total_rows",
        "repeats AS approx_duplicate_key_count",
        "margin",
        f"{scoring.as_number(scoring.intact_score('repeats', 'total'))} AS approx_uniqueness_score",
    )
