"""Diagnostic queries over a staging table, and labelled batches of them.

These speak the SQL dialect: NULL comparisons do not match, and trimming
removes ASCII spaces only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.rules import Rules, outside_range
from plumbline.functions.values import nan_to_null, orderable
from plumbline.operators.profile import repeated_rows
from plumbline.operators.table import Table


def required_fields(t: Table, names: Sequence[str]) -> list:
    absent = [n for n in names if t.field(n) is None]
    if absent:
        raise ValueError(f"no such column: {', '.join(absent)}")
    return [t.field(n) for n in names]


def any_outside(t: Table, ranges: Rules) -> Column:
    tests = [outside_range(f.ref, f.dtype, ranges[f.name]) for f in required_fields(t, list(ranges))]
    return reduce(or_, [test for test in tests if test is not None], F.lit(False))


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One wide row: missing_<column> for each column, and total_rows.

    The sums of a table without rows are NULL, as SQL has it.
    """
    t = Table(df)
    return t.df.agg(
        *(
            F.sum(F.when(f.missing, 1).otherwise(0)).alias(f"missing_{f.name}")
            for f in required_fields(t, columns)
        ),
        F.count("*").alias("total_rows"),
    )


def duplicate_key_values(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, most frequent first; NULL is one value."""
    t = Table(df)
    (field,) = required_fields(t, [key])
    value = F.expr(nan_to_null(field.ref, field.dtype)).alias("value")
    groups = t.df.select(value).groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    if orderable(field.dtype):
        groups = groups.orderBy(F.desc("n"), "value")
    return groups.toDF(key, "occurrence_count")


def duplicate_row_groups(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that occur more than once over `columns` (all by default), with dup_count."""
    t = Table(df)
    fields = required_fields(t, columns if columns is not None else df.columns)
    groups = repeated_rows(t, fields)
    return groups.select(*(f.col.alias(f.name) for f in fields), F.col("n").alias("dup_count"))


def out_of_range_rows(df: DataFrame, ranges: Rules, columns: Sequence[str]) -> DataFrame:
    """Rows with any value outside its range, projected to `columns`."""
    t = Table(df)
    return t.df.where(any_outside(t, ranges)).select(*(f.col.alias(f.name) for f in required_fields(t, columns)))


def categories_outside(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct raw values whose trimmed lower-case form is not allowed."""
    t = Table(df)
    (field,) = required_fields(t, [column])
    lowered = [a.lower() for a in allowed]
    values = t.df.select(field.col).distinct()
    return values.where(field.col.isNotNull() & ~F.lower(F.trim(field.col)).isin(lowered)).toDF(column)


def untrimmed_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct raw values with spaces around them."""
    t = Table(df)
    (field,) = required_fields(t, [column])
    return t.df.where(field.col != F.trim(field.col)).select(field.col.alias(column)).distinct()


def health_snapshot(df: DataFrame, key: str, ranges: Rules, required: Sequence[str]) -> DataFrame:
    """One row of counts: rows, repeated key values, out-of-range rows, incomplete rows.

    One pass: the row counts ride along with the group-by on the key.
    """
    t = Table(df)
    (key_field,) = required_fields(t, [key])
    incomplete = reduce(or_, (f.missing for f in required_fields(t, required)))
    rows = t.df.select(
        key_field.key.alias("key"),
        F.when(any_outside(t, ranges), 1).otherwise(0).alias("invalid"),
        F.when(incomplete, 1).otherwise(0).alias("incomplete"),
    )
    groups = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("invalid").alias("invalid"), F.sum("incomplete").alias("incomplete")
    )
    zero = F.lit(0).cast("long")
    return groups.agg(
        F.coalesce(F.sum("n"), zero).alias("total_rows"),
        F.count_if(F.col("n") > 1).alias(f"duplicate_{key}s"),
        F.coalesce(F.sum("invalid"), zero).alias("invalid_value_rows"),
        F.coalesce(F.sum("incomplete"), zero).alias("incomplete_rows"),
    )


Check = Callable[[], DataFrame]


def run_checks(
    spark: SparkSession, checks: Mapping[str, Check], folder: str | None = None
) -> dict[str, DataFrame | str]:
    """Run a labelled batch of checks; a failing one yields `<label>_error`, not an abort.

    Without `folder` the frames come back lazy, and only errors found while
    building a plan are caught.  With `folder` each result is written to
    `<folder>/<label>` as Parquet and read back, so run-time errors are caught
    too and no result is computed twice.
    """
    results: dict[str, DataFrame | str] = {}
    for label, check in checks.items():
        try:
            frame = check()
            if folder is not None:
                path = f"{folder}/{label}"
                frame.write.mode("overwrite").parquet(path)
                frame = spark.read.schema(frame.schema).parquet(path)
            results[label] = frame
        except Exception as error:  # whatever stops one check must not stop the others
            results[f"{label}_error"] = str(error)
    return results
