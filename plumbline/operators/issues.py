"""The issues log: for each column and kind of issue, the rows that show it.

All of them by default.  With a `cap`, the first so many per column and kind,
by `row_id`, which must then be unique and not null.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.rules import Rules, outside_range
from plumbline.operators.table import COLUMNS_PER_PASS, ROW, Table

# The kinds in log order.
KINDS = ("missing_value", "duplicate_key", "invalid_value")
MISSING, DUPLICATE, INVALID = range(3)

# Reducers that share the cut of one column's issues before the last one.
SALTS = 64

# Rows of one repeated key that go to one task; a key with more is dealt over as many tasks as it needs.
ROWS_PER_TASK = 1_000_000

# Rows of the flag that says whether there are several rows without a key.
FLAG_ROWS = 16

# Keys that are dealt over several tasks, those with most rows: any other has at most a 1000th of all rows.
DEALT_KEYS = 1000

Test = tuple[int, int, int, Column]  # kind, place in the log, ordinal, predicate


def _flagged(t: Table, tests: Sequence[Test]) -> DataFrame:
    """One row per (kind, place, ordinal, row) that fails a test.

    Rows without any issue are filtered out first, by a predicate the Parquet
    reader can use to skip row groups, before any array is built.
    """
    pieces = []
    for start in range(0, len(tests), COLUMNS_PER_PASS):
        chunk = tests[start : start + COLUMNS_PER_PASS]
        marks = F.array(
            *(
                F.when(test, F.expr(f"struct({kind} AS kind, {place} AS place, {ordinal} AS ordinal)"))
                for kind, place, ordinal, test in chunk
            )
        )
        pieces.append(
            t.df.where(reduce(or_, (test for *_, test in chunk)))
            .select(ROW, F.inline(F.array_compact(marks)))
        )
    return reduce(DataFrame.unionByName, pieces)


def _first(flagged: DataFrame, cap: int) -> DataFrame:
    """The `cap` smallest row_index values of every (kind, place).

    Each task keeps its own first rows before the shuffle; tasks are then
    spread over SALTS reducers per column, so that neither cut sees more than
    a bounded number of rows per input task.
    """
    salted = flagged.withColumn("salt", F.spark_partition_id() % SALTS)
    group = ["kind", "place"]
    near = W.partitionBy(*group, "salt").orderBy(ROW)
    final = W.partitionBy(*group).orderBy(ROW)
    return (
        salted.withColumn("rank", F.row_number().over(near))
        .where(F.col("rank") <= cap)
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= cap)
        .select("kind", "place", "ordinal", ROW)
    )


def _repeated(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("key")
        .agg(F.count("*").alias("n"), F.min(ROW).alias("start"))
        .where("n > 1")
        .select(F.col("key").alias("repeated"), "start")
    )


def _all_duplicates(rows: DataFrame, rows_per_task: int, clustered: bool) -> DataFrame:
    """Every row whose key occurs more than once.

    Rows without a key, of which there may be very many, are not joined by it: they stay if there are two.
    Keys are counted first; the rows of one with more than `rows_per_task` are dealt over as many parts as
    its count asks for, by a join with the DEALT_KEYS most frequent keys at most, which is broadcast. In a table
    clustered by the key no row leaves its bucket.
    """
    present = rows.where("key IS NOT NULL")
    repeated = present.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    if clustered:
        kept = present.join(repeated.select("key"), "key", "left_semi")
    else:
        heavy = repeated.where(F.col("n") > rows_per_task).orderBy(F.desc("n"), "key").limit(DEALT_KEYS)
        heavy = F.broadcast(heavy.select(F.col("key"), F.ceil(F.col("n") / rows_per_task).cast("int").alias("parts")))
        dealt = present.join(heavy, "key", "left").withColumn(
            "part", F.coalesce(F.pmod(F.xxhash64(ROW), F.col("parts")).cast("int"), F.lit(0))
        )
        parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
        wanted = repeated.join(heavy, "key", "left").select("key", parts)
        kept = dealt.join(wanted, ["key", "part"], "left_semi")
    keyless = rows.where("key IS NULL").withColumn("part", F.pmod(F.xxhash64(ROW), F.lit(FLAG_ROWS)).cast("int"))
    flag = F.explode(F.sequence(F.lit(0), F.lit(FLAG_ROWS - 1))).alias("part")
    several = keyless.agg(F.count("*").alias("n")).where("n > 1").select(flag)  # FLAG_ROWS rows or none
    return kept.select(ROW).union(keyless.join(F.broadcast(several), "part", "left_semi").select(ROW))


def _first_duplicates(rows: DataFrame, cap: int) -> DataFrame:
    """The first `cap` rows whose key occurs more than once.

    They all belong to the `cap` repeated keys that start earliest: a row of any
    later key has `cap` earlier starts before it.  So the rows are only filtered
    against `cap` keys, and the size of a key's group never matters.
    """
    earliest = _repeated(rows).orderBy("start").limit(cap).select("repeated")
    return (
        rows.join(earliest, F.col("key").eqNullSafe(F.col("repeated")), "left_semi").orderBy(ROW).limit(cap).select(ROW)
    )


def _duplicates(t: Table, key: str, cap: int | None, rows_per_task: int, clustered: bool) -> DataFrame:
    field = t.field(key)
    rows = t.df.select(field.comparable("issues", clustered).alias("key"), ROW)
    found = _all_duplicates(rows, rows_per_task, clustered) if cap is None else _first_duplicates(rows, cap)
    return found.select(
        F.lit(DUPLICATE).alias("kind"), F.lit(0).alias("place"), F.lit(field.ordinal).alias("ordinal"), ROW
    )


def _missing_tests(t: Table) -> list[Test]:
    return [(MISSING, f.ordinal, f.ordinal, f.missing) for f in t.fields]


def _range_tests(t: Table, rules: Rules) -> list[Test]:
    tests = []
    for place, (name, rule) in enumerate(rules.items()):
        field = t.field(name)
        test = outside_range(field.ref, field.dtype, rule) if field else None
        if test is not None:
            tests.append((INVALID, place, field.ordinal, test))
    return tests


def _log(
    t: Table,
    tests: Sequence[Test],
    key: str | None,
    cap: int | None,
    rows_per_task: int = ROWS_PER_TASK,
    clustered: bool = False,
) -> DataFrame:
    parts = []
    if tests:
        flagged = _flagged(t, tests).select("kind", "place", "ordinal", ROW)
        parts.append(flagged if cap is None else _first(flagged, cap))
    if t.field(key) is not None:
        parts.append(_duplicates(t, key, cap, rows_per_task, clustered))
    if not parts:
        kind = T.StructType(
            [
                T.StructField(ROW, T.LongType()),
                T.StructField("column", T.StringType()),
                T.StructField("issue_type", T.StringType()),
            ]
        )
        return t.df.sparkSession.createDataFrame([], kind)
    kinds = F.array(*(F.lit(k) for k in KINDS))
    log = reduce(DataFrame.unionByName, parts)
    if cap is not None:
        log = log.orderBy("kind", "place", ROW)
    return log.select(ROW, t.column_name(), F.element_at(kinds, F.col("kind") + 1).alias("issue_type"))


def issues_missing(df: DataFrame, row_id: str, cap: int | None = None) -> DataFrame:
    """Rows of each column with a missing value; with a cap, the first ones."""
    t = Table(df, row_id)
    return _log(t, _missing_tests(t), None, cap)


def issues_duplicate_key(
    df: DataFrame,
    row_id: str,
    key: str | None,
    cap: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    clustered: bool = False,
) -> DataFrame:
    """All members of repeated keys; missing keys are one key.

    A key with more than `rows_per_task` rows is dealt over several tasks; `clustered` says that the table is
    bucketed by the key.
    """
    return _log(Table(df, row_id), [], key, cap, rows_per_task, clustered)


def issues_invalid(df: DataFrame, row_id: str, rules: Rules, cap: int | None = None) -> DataFrame:
    """Rows of each ruled column outside its range; allow-lists are not logged."""
    t = Table(df, row_id)
    return _log(t, _range_tests(t, rules), None, cap)


def issues_log(
    df: DataFrame,
    row_id: str,
    key: str | None = None,
    rules: Rules | None = None,
    cap: int | None = None,
    clustered: bool = False,
) -> DataFrame:
    """Missing values, duplicate keys and range violations.

    With a cap the log is in order: columns, then the key, then rules.
    """
    t = Table(df, row_id)
    return _log(t, [*_missing_tests(t), *_range_tests(t, rules or {})], key, cap, clustered=clustered)
