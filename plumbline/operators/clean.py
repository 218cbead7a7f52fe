"""Building a deduplicated, standardised and flagged copy of a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions.rules import Rules, outside_range
from plumbline.functions.text import sentence_case
from plumbline.functions.values import hashable
from plumbline.operators.table import ROW, Field, Table


@dataclass(frozen=True)
class CleanSpec:
    """What `clean` does; every part is optional.

    Columns keep their names and order; `drop` leaves some out.  `flag_ranges`
    marks rows (it never deletes them) in the column `flag`.
    """

    key: str | None = None
    trim: Sequence[str] = ()
    sentence: Sequence[str] = ()
    flag_ranges: Rules = field(default_factory=dict)
    drop: Sequence[str] = ()
    flag: str = "is_flagged_invalid"


def keep_first(df: DataFrame, key: str, row_id: str, clustered: bool = False) -> DataFrame:
    """One row of every key, that with the smallest `row_id`; missing keys are one key.

    Rows without a `row_id` come last; ties fall to the smallest hash of the row,
    so exactly one row per key stays.  Every task drops all but its own first row
    of a key before the shuffle, so a hot key sends one row per task.  `clustered`
    says that the table is bucketed by the key; then there is no shuffle.
    """
    t = Table(df, row_id)
    field_ = _named(t, [key])[0]
    # Types without a hash take no part in breaking ties.
    cells = [F.xxhash64(f.col) for f in t.fields if hashable(f.dtype)]
    order = W.partitionBy("key").orderBy(F.col(ROW).asc_nulls_last(), *cells)
    return (
        t.df.select("*", field_.comparable("keep_first", clustered).alias("key"))
        .select("*", F.row_number().over(order).alias("rank"))
        .where("rank = 1")
        .drop("key", "rank")
        .toDF(*t.names)
    )


def _named(t: Table, names: Sequence[str]) -> list[Field]:
    absent = [n for n in names if t.field(n) is None]
    if absent:
        raise ValueError(f"no such column: {', '.join(absent)}")
    return [t.field(n) for n in names]


def standardize(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Trim and recase text, add the flag, leave out dropped columns; one projection.

    Every column the spec names must exist, and the flag must not.
    """
    t = Table(df)
    _named(t, [*spec.trim, *spec.sentence, *spec.drop, *spec.flag_ranges])
    if spec.flag_ranges and spec.flag in set(df.columns) - set(spec.drop):
        raise ValueError(f"column {spec.flag} already exists")
    columns = []
    for f in t.fields:
        if f.name in spec.drop:
            continue
        if f.name in spec.sentence:
            columns.append(F.expr(sentence_case(f.ref)).alias(f.name))
        elif f.name in spec.trim:
            columns.append(F.trim(f.col).alias(f.name))
        else:
            columns.append(f.col.alias(f.name))
    if spec.flag_ranges:
        tests = [outside_range(f.ref, f.dtype, spec.flag_ranges[f.name]) for f in _named(t, list(spec.flag_ranges))]
        outside = reduce(or_, [x for x in tests if x is not None], F.lit(False))
        columns.append(F.when(outside, 1).otherwise(0).alias(spec.flag))
    return t.df.select(*columns)


def clean(df: DataFrame, spec: CleanSpec, row_id: str) -> DataFrame:
    """Deduplicate, then standardise and flag.

    `row_id` only orders the rows; add it to `spec.drop` to leave it out.
    """
    rows = keep_first(df, spec.key, row_id) if spec.key is not None else df
    return standardize(rows, spec)
