"""Date formats found in text columns, reported beside the scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.table import Table


def date_format_label(c: Column) -> Column:
    """The format a date is written in; what is no date in any of them is "other".

    Day and month cannot be told apart when both are at most 12; such dates
    are labelled ambiguous rather than guessed.
    """

    def reads(pattern: str, shape: str, text: Column = c) -> Column:
        return c.rlike(shape) & F.try_to_date(text, pattern).isNotNull()

    slashed = r"\A[0-9]{2}/[0-9]{2}/[0-9]{4}\z"
    day_first, month_first = reads("dd/MM/yyyy", slashed), reads("MM/dd/yyyy", slashed)
    spelt = F.concat(F.substring(c, 1, 3), F.initcap(F.substring(c, 4, 3)), F.substring(c, 7, 5))
    return (
        F.when(c.isNull(), "missing")
        .when(reads("yyyy-MM-dd", r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), "yyyy-MM-dd")
        .when(reads("dd-MMM-yyyy", r"\A[0-9]{2}-[A-Za-z]{3}-[0-9]{4}\z", spelt), "dd-MMM-yyyy")
        .when(day_first & month_first, "ambiguous")
        .when(day_first, "dd/MM/yyyy")
        .when(month_first, "MM/dd/yyyy")
        .otherwise("other")
    )


def date_formats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column and format: the number of rows."""
    t = Table(df)
    parts = []
    for name in columns:
        field = t.field(name)
        if field is None:
            raise ValueError(f"no such column: {name}")
        label = date_format_label(field.col.cast("string")).alias("date_format")
        parts.append(
            t.df.select(label)
            .groupBy("date_format")
            .agg(F.count("*").alias("n_rows"))
            .select(F.lit(name).alias("column"), "date_format", "n_rows")
        )
    return reduce(DataFrame.unionByName, parts)
