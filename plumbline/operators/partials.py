"""Profiles that merge: the counts of parts of a table, kept so that the whole can be scored without the parts.

A profile is three tables, for cells, text values and keys. Rows of several profiles that belong together
are summed (fingerprints of casings: least and greatest), which gives the profile of all their rows:

* cells - per column: rows, missing and invalid cells;
* texts - per text column and folded value: its rows, those padded or unlisted, the range of its casings;
* keys  - per key value: its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.rules import Rules
from plumbline.functions.values import key_text, quoted
from plumbline.operators.profile import COUNTS, cell_counts, listed_only, text_marks
from plumbline.operators.table import Table

# What each table of a profile holds beside its batch columns and `ordinal`: what tells rows apart, how they merge.
IDENTITY = {
    "cells": ("column",),
    "texts": ("column", "folded"),
    "keys": ("column", "key"),
}
MERGED = {
    "cells": {"total": "sum", "missing": "sum", "invalid": "sum"},
    "texts": {
        "n": "sum", "padded": "sum", "unlisted": "sum",
        "low": "min", "high": "max", "low2": "min", "high2": "max",
    },
    "keys": {"n": "sum"},
}


@dataclass(frozen=True)
class Profile:
    """The three tables of a profile; `by` names their batch columns."""

    cells: DataFrame
    texts: DataFrame
    keys: DataFrame
    by: tuple[str, ...] = ()

    def parts(self) -> dict[str, DataFrame]:
        return {"cells": self.cells, "texts": self.texts, "keys": self.keys}


def _named(t: Table) -> list:
    return [F.col(ref).alias(name) for ref, name in zip(t.by_refs, t.by, strict=True)]


def profile(
    df: DataFrame, key: str | None = None, rules: Rules | None = None, row_id: str | None = None, by: Sequence[str] = ()
) -> Profile:
    """The profile of a table (of each of its batches, with `by`); each of the three tables is one aggregate.

    Columns are told apart by name and carry their position; batch columns keep their names. Text is judged by its allow-list here, so a profile
    keeps what the rules said when it was made. A missing key is a key.
    """
    clash = {"is_total", "ordinal", *(c for part in IDENTITY for c in (*IDENTITY[part], *MERGED[part]))} & set(by)
    if clash:
        raise ValueError(f"a batch column cannot be named {', '.join(sorted(clash))}")
    t = Table(df, row_id, by)
    rules = rules or {}
    allowed = listed_only(t, rules)
    text = t.text_fields
    other = [f for f in t.fields if f not in text]
    cell_rules = {f.name: rules[f.name] for f in t.fields if f.name in rules and f.ref not in allowed}
    cells = cell_counts(t, other, cell_rules, listed=t.fields)
    cells = cells.groupBy(*t.by_refs, "ordinal").agg(*(F.sum(c).alias(c) for c in MERGED["cells"]))
    cells = cells.select(*_named(t), "ordinal", t.column_name(), *MERGED["cells"])

    if text:
        texts = text_marks(t, text)
        unlisted = F.lit(False)
        for ref, values in allowed.items():
            unlisted = unlisted | ((F.col("ref") == ref) & ~F.col("folded").isin(values))
        texts = texts.withColumn(
            "unlisted", F.when(F.col("folded").isNotNull() & unlisted, F.col("n")).otherwise(F.lit(0).cast("long"))
        ).withColumn("ordinal", F.expr("CAST(substr(ref, 2) AS INT)"))
        texts = texts.select(*_named(t), "ordinal", t.column_name(), "folded", *MERGED["texts"])
    else:
        empty = "CAST(NULL AS STRING) AS folded", *(f"0L AS {c}" for c in MERGED["texts"])
        texts = cells.selectExpr(*_refs(by), "ordinal", "column", *empty).where("false")

    field = t.field(key)
    if field is not None:
        rows = t.df.select(*t.by_refs, field.comparable("profile").alias("key"))
        keys = rows.groupBy(*t.by_refs, "key").agg(F.count("*").alias("n"))
        keys = keys.select(
            *_named(t),
            F.lit(field.ordinal).alias("ordinal"),
            F.lit(field.name).alias("column"),
            F.expr(key_text("key", field.dtype)).alias("key"),
            "n",
        )
    else:
        keys = cells.selectExpr(*_refs(by), "ordinal", "column", "CAST(NULL AS STRING) AS key", "0L AS n").where("false")
    return Profile(cells, texts, keys, tuple(by))


def _refs(names: Sequence[str]) -> list[str]:
    return [quoted(n) for n in names]


def merge(p: Profile, by: Sequence[str] = ()) -> Profile:
    """The profile with batch columns `by` alone, some of those it has: what they no longer tell apart is merged.

    A column's position is the least it has in any batch, so a batch may have other columns than the rest.
    """
    absent = set(by) - set(p.by)
    if absent:
        raise ValueError(f"no such batch column: {', '.join(sorted(absent))}")

    def merged(part: str, rows: DataFrame) -> DataFrame:
        sums = [getattr(F, how)(c).alias(c) for c, how in MERGED[part].items()]
        return rows.groupBy(*_refs(by), *_refs(IDENTITY[part])).agg(F.min("ordinal").alias("ordinal"), *sums)

    return Profile(*(merged(part, rows) for part, rows in p.parts().items()), tuple(by))


def _as_counts(by: list[str], rows: DataFrame, **known: str) -> DataFrame:
    counts = (f"{known.get(c, '0L')} AS {c}" for c in COUNTS)
    return rows.selectExpr(*by, "`column`", "ordinal", *counts)


def counts(p: Profile) -> DataFrame:
    """What `column_counts` gives for the same rows: per batch and column its ordinal and the COUNTS."""
    by = _refs(p.by)
    m = merge(p, p.by)
    formatting = "if(low <> high OR low2 <> high2, n, padded)"
    texts = m.texts.groupBy(*by, "`column`").agg(
        F.min("ordinal").alias("ordinal"),
        F.sum("n").alias("total"),
        F.expr("sum(if(folded IS NULL, n, 0L)) AS missing"),
        F.sum("unlisted").alias("invalid"),
        F.expr(f"sum(if(folded IS NULL, 0L, {formatting})) AS formatting"),
    )
    keys = m.keys.groupBy(*by, "`column`").agg(F.min("ordinal").alias("ordinal"), F.expr("sum(n - 1) AS repeats"))
    parts = [
        _as_counts(by, m.cells, total="total", missing="missing", invalid="invalid"),
        _as_counts(by, texts, total="total", missing="missing", invalid="invalid", formatting="formatting"),
        _as_counts(by, keys, duplicate_keys="repeats"),
    ]
    united = reduce(DataFrame.unionByName, parts)
    return united.groupBy(*by, "`column`").agg(
        F.min("ordinal").alias("ordinal"), *(F.sum(c).alias(c) for c in COUNTS)
    ).select(*by, "ordinal", "column", *COUNTS)


def counts_and_total(p: Profile) -> DataFrame:
    """`counts` of every batch and, with `is_total`, of all batches together.

    The parts are grouped twice by grouping sets, over the merged values and not over rows, so the table itself is
    read once.
    """
    if not p.by:
        raise ValueError("a profile without batch columns is its own total")
    by = _refs(p.by)

    def both(part: str, rows: DataFrame) -> DataFrame:
        cols = [F.col(c) for c in (*by, *_refs(IDENTITY[part]))]
        few = cols[len(by) :]
        sums = [getattr(F, how)(c).alias(c) for c, how in MERGED[part].items()]
        total = F.grouping_id().alias("set")
        sets = rows.groupingSets([cols, few], *cols)
        return sets.agg(F.min("ordinal").alias("ordinal"), *sums, total).withColumn("is_total", F.expr("set > 0")).drop("set")

    parts = {part: both(part, rows) for part, rows in p.parts().items()}
    return counts(Profile(**parts, by=("is_total", *p.by)))
