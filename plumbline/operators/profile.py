"""Per-column counts behind the scores.

Three independent aggregates, each reading only the columns it needs:

* cells - missing and invalid counts, one global conditional aggregate per
  group of columns, no grouping key and so no data shuffle;
* text  - missing and formatting counts from one group-by on distinct values;
* key   - duplicate keys from one group-by on the key.

All three combine map-side, so a value that holds a third of the table costs
one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import scoring
from plumbline.functions.rules import Rules, allowed_values, violates
from plumbline.functions.text import compact, compact_literal, padded, strip, tail
from plumbline.functions.values import is_missing, nan_to_null
from plumbline.operators.table import COLUMNS_PER_PASS, Field, Table

COUNTS = ("total", "missing", "invalid", "duplicate_keys", "formatting")


def _counts(**known: str) -> list[str]:
    return [f"{known.get(name, '0L')} AS {name}" for name in COUNTS]


def _row(f: Field, **known: str) -> str:
    return f"struct({', '.join([f'{f.ordinal} AS ordinal', *_counts(**known)])})"


def cell_counts(
    t: Table, counted: Sequence[Field], rules: Rules | None = None, listed: Sequence[Field] = ()
) -> DataFrame:
    """Missing counts of `counted`, invalid counts of every field with a rule.

    `listed` fields get a row of zeros, so that a table without rows still has
    one row per column.
    """
    rules = rules or {}
    tests = {f.ref: violates(f.ref, f.dtype, rules[f.name]) for f in t.fields if f.name in rules}
    ruled = {ref for ref, test in tests.items() if test is not None}
    fields = [f for f in t.fields if f in counted or f.ref in ruled]

    passes = []
    for start in range(0, max(len(fields), 1), COLUMNS_PER_PASS):
        chunk = fields[start : start + COLUMNS_PER_PASS]
        aggregates = [F.expr("count(*) AS total")]
        aggregates += [F.expr(f"count_if({is_missing(f.ref, f.dtype)}) AS missing_{f.ref}") for f in chunk if f in counted]
        aggregates += [F.count_if(tests[f.ref]).alias(f"invalid_{f.ref}") for f in chunk if f.ref in ruled]
        rows = []
        for f in chunk:
            known = {"total": "total", "missing": f"missing_{f.ref}"} if f in counted else {}
            if f.ref in ruled:
                known["invalid"] = f"invalid_{f.ref}"
            rows.append(_row(f, **known))
        if start == 0:
            rows += [_row(f) for f in listed if f not in fields]
        wide = t.df.groupBy(*t.by_refs).agg(*aggregates)
        passes.append(wide.selectExpr(*t.by_refs, f"inline(array({', '.join(rows)}))"))
    return reduce(DataFrame.unionByName, passes)


def _text_cells(t: Table, fields: Sequence[Field]) -> DataFrame:
    """Every cell of the text columns as (ref, value, padded)."""
    cells = t.df.selectExpr(*t.by_refs, *(f"CAST({f.ref} AS STRING) AS {f.ref}" for f in fields)).unpivot(
        t.by_refs, [f.ref for f in fields], "ref", "value"
    )
    ends = cells.selectExpr("*", f"{tail('value')} AS tail")
    return ends.selectExpr(*t.by_refs, "ref", "value", f"{padded('value', 'tail')} AS padded")


def text_marks(t: Table, fields: Sequence[Field]) -> DataFrame:
    """One row per distinct folded value of each text column.

    `n` rows hold the value, `padded` of them with whitespace around it.  `low` to
    `high2` are the least and greatest of two 64-bit fingerprints of its casings.
    """
    stripped = _text_cells(t, fields).selectExpr(
        *t.by_refs, "ref", "padded", f"if(padded, {strip('value')}, value) AS stripped"
    )
    folded = stripped.selectExpr("*", "lower(stripped) AS text")
    keyed = folded.selectExpr(
        *t.by_refs,
        "ref",
        "padded",
        f"{compact('text')} AS folded",
        "xxhash64(stripped) AS mark",
        "xxhash64('casing', stripped) AS mark2",
    )
    return keyed.groupBy(*t.by_refs, "ref", "folded").agg(
        F.expr("count(*) AS n"),
        F.expr("count_if(padded) AS padded"),
        F.expr("min(mark) AS low"),
        F.expr("max(mark) AS high"),
        F.expr("min(mark2) AS low2"),
        F.expr("max(mark2) AS high2"),
    )


def text_values(t: Table, fields: Sequence[Field]) -> DataFrame:
    """`text_marks`, with `variants` instead: whether the value occurs in more than one casing.

    Whether two casings exist is read off the least and greatest 128-bit fingerprint, a
    fixed-width aggregate that needs no second shuffle by casing.
    """
    return text_marks(t, fields).selectExpr(
        *t.by_refs, "ref", "folded", "n", "padded", "low <> high OR low2 <> high2 AS variants"
    )


# Field i is column c<i>.
_ORDINAL = "CAST(substr(ref, 2) AS INT) AS ordinal"


def listed_only(t: Table, rules: Rules) -> dict[str, list[str]]:
    """Text columns whose rule is an allow-list alone, with its folded values."""
    return {
        f.ref: [compact_literal(a) for a in allowed_values(rules[f.name])]
        for f in t.text_fields
        if "allowed" in rules.get(f.name, {}) and not {"min", "max"} & set(rules[f.name])
    }


def text_counts(t: Table, fields: Sequence[Field], allowed: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Missing, formatting and allow-list counts of text columns.

    `allowed` maps column refs to folded values; they are compared once per
    distinct value rather than once per row.
    """
    invalid = F.lit(False)
    for ref, values in (allowed or {}).items():
        invalid = invalid | ((F.col("ref") == ref) & ~F.col("folded").isin(list(values)))
    per_column = (
        text_values(t, fields)
        .select("*", (F.col("folded").isNotNull() & invalid).alias("unlisted"))
        .groupBy(*t.by_refs, "ref")
        .agg(
            F.expr("sum(n) AS total"),
            F.expr("sum(if(folded IS NULL, n, 0L)) AS missing"),
            F.expr("sum(if(unlisted, n, 0L)) AS invalid"),
            F.expr("sum(if(variants, n, padded)) AS formatting"),
        )
    )
    known = _counts(total="total", missing="missing", invalid="invalid", formatting="formatting")
    return per_column.selectExpr(*t.by_refs, _ORDINAL, *known)


def _key_repeats(t: Table, key: Field, clustered: bool = False) -> DataFrame:
    """Rows, and rows whose key already occurred; missing keys are one key."""
    value = key.comparable("key_uniqueness", True) if clustered else key.key
    groups = t.df.select(*t.by_refs, value.alias("key")).groupBy(*t.by_refs, "key").agg(F.expr("count(*) AS n"))
    return groups.groupBy(*t.by_refs).agg(
        F.expr("coalesce(sum(n), 0L) AS total"), F.expr("coalesce(sum(n - 1), 0L) AS repeats")
    )


def key_counts(t: Table, key: Field) -> DataFrame:
    known = _counts(duplicate_keys="repeats")
    return _key_repeats(t, key).selectExpr(*t.by_refs, f"{key.ordinal} AS ordinal", *known)


def column_counts(
    df: DataFrame,
    key: str | None = None,
    rules: Rules | None = None,
    row_id: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per column (and batch): ordinal, column and the COUNTS.

    Text columns are read by the text pass alone, allow-lists included, unless
    they carry a range.
    """
    t = Table(df, row_id, by)
    rules = rules or {}
    text = t.text_fields
    other = [f for f in t.fields if f not in text]
    allowed = listed_only(t, rules)
    cell_rules = {f.name: rules[f.name] for f in t.fields if f.name in rules and f.ref not in allowed}
    parts = [cell_counts(t, other, cell_rules, listed=t.fields)]
    if text:
        parts.append(text_counts(t, text, allowed))
    key_field = t.field(key)
    if key_field is not None:
        parts.append(key_counts(t, key_field))
    merged = (
        reduce(DataFrame.unionByName, parts)
        .groupBy(*t.by_refs, "ordinal")
        .agg(*(F.expr(f"sum({c}) AS {c}") for c in COUNTS))
    )
    return t.named(merged.select(*t.by_refs, "ordinal", t.column_name(), *COUNTS))


def completeness(df: DataFrame, row_id: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per column: missing_count, missing_pct, completeness_score."""
    t = Table(df, row_id, by)
    return t.named(
        cell_counts(t, t.fields).select(
            *t.by_refs,
            t.column_name(),
            F.col("missing").alias("missing_count"),
            F.expr(f"{scoring.as_number(scoring.share('missing', 'total'))} AS missing_pct"),
            F.expr(f"{scoring.as_number(scoring.missing_score('missing', 'total'))} AS completeness_score"),
        )
    )


def presence(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column but `keep` reduced to TRUE or NULL.

    Profiling completeness after a join only needs this much of each side, so
    the join need not shuffle the values themselves.
    """
    t = Table(df)
    return t.df.select(
        *(
            (f.col if f.name in keep else F.when(~f.missing, F.lit(True))).alias(f.name)
            for f in t.fields
        )
    )


def validity(df: DataFrame, rules: Rules, row_id: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per column with a rule: invalid_count, invalid_pct, validity_score.

    Rules for columns the table does not have are ignored.
    """
    t = Table(df, row_id, by)
    ruled = [f for f in t.fields if f.name in rules]
    # Counting the ruled fields gives each of their rows the table's row count.
    counts = cell_counts(t, ruled or t.fields[:1], rules)
    if not ruled:
        counts = counts.where("false")
    return t.named(
        counts.select(
            *t.by_refs,
            t.column_name(),
            F.col("invalid").alias("invalid_count"),
            F.expr(f"{scoring.as_number(scoring.share('invalid', 'total'))} AS invalid_pct"),
            F.expr(f"{scoring.as_number(scoring.intact_score('invalid', 'total'))} AS validity_score"),
        )
    )


def _text_fields(t: Table, columns: Sequence[str] | None) -> list[Field]:
    fields = [f for f in t.text_fields if columns is None or f.name in columns]
    if not fields:
        raise ValueError("no text column to check")
    return fields


def consistency(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    row_id: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per text column: formatting_issue_count, consistency_score.

    Text columns without any value are left out; `columns` restricts the check.
    """
    t = Table(df, row_id, by)
    fields = _text_fields(t, columns)
    return t.named(
        text_counts(t, fields)
        .where("missing < total")
        .select(
            *t.by_refs,
            t.column_name(),
            F.col("formatting").alias("formatting_issue_count"),
            F.expr(f"{scoring.as_number(scoring.intact_score('formatting', 'total'))} AS consistency_score"),
        )
    )


def padded_values(df: DataFrame, columns: Sequence[str] | None = None, row_id: str | None = None) -> DataFrame:
    """Per text column: rows whose value has whitespace around it."""
    t = Table(df, row_id)
    fields = _text_fields(t, columns)
    tails = t.df.selectExpr(*(f.ref for f in fields), *(f"{tail(f.ref)} AS t{f.ref}" for f in fields))
    counts = tails.selectExpr(*(f"count_if({padded(f.ref, f't{f.ref}')}) AS {f.ref}" for f in fields))
    listed = ", ".join(f"struct({f.ordinal} AS ordinal, {f.ref} AS padded_count)" for f in fields)
    return counts.selectExpr(f"inline(array({listed}))").select(t.column_name(), "padded_count")


def case_variants(df: DataFrame, columns: Sequence[str] | None = None, row_id: str | None = None) -> DataFrame:
    """Per text column: values that occur in several casings, and the rows that hold them."""
    t = Table(df, row_id)
    fields = _text_fields(t, columns)
    return (
        text_values(t, fields)
        .groupBy("ref")
        .agg(
            F.expr("count_if(variants) AS variant_values"),
            F.expr("sum(if(variants, n, 0L)) AS variant_rows"),
        )
        .selectExpr(_ORDINAL, "variant_values", "variant_rows")
        .select(t.column_name(), "variant_values", "variant_rows")
    )


def key_uniqueness(
    df: DataFrame, key: str, row_id: str | None = None, by: Sequence[str] = (), clustered: bool = False
) -> DataFrame:
    """For the key column: duplicate_key_count, uniqueness_score.

    `clustered` says that the table is bucketed by the key, which is then counted bucket by bucket.
    """
    t = Table(df, row_id, by)
    field = t.field(key)
    if field is None:
        raise ValueError(f"no such column: {key}")
    return t.named(
        _key_repeats(t, field, clustered).select(
            *t.by_refs,
            F.lit(key).alias("column"),
            F.col("repeats").alias("duplicate_key_count"),
            F.expr(f"{scoring.as_number(scoring.intact_score('repeats', 'total'))} AS uniqueness_score"),
        )
    )


# NULL flags of so many columns go into one integer.
_FLAGS = 60


def _row_key(fields: Sequence[Field]) -> list[str]:
    """128 bits of a row's cells as two integers, from their typed values.

    A hash passes NULL by, so which cells are missing is hashed as well, as bits.
    """
    cells = []
    for f in fields:
        value = nan_to_null(f.ref, f.dtype)
        if isinstance(f.dtype, (T.FloatType, T.DoubleType)):
            value = f"({value} + 0.0D)"  # -0.0 is 0.0
        cells.append(value)
    for start in range(0, len(fields), _FLAGS):
        flags = (f"if({is_missing(f.ref, f.dtype)}, {1 << i}L, 0L)" for i, f in enumerate(fields[start : start + _FLAGS]))
        cells.append(" + ".join(flags))
    listed = ", ".join(cells)
    return [f"xxhash64({listed}) AS mark", f"xxhash64('row', {listed}) AS mark2"]


def repeated_rows(t: Table, fields: Sequence[Field]) -> DataFrame:
    """The distinct rows over `fields` that occur more than once, with their count `n`."""
    refs = [f.ref for f in fields]
    compared = t.df.selectExpr(*(f"{nan_to_null(f.ref, f.dtype)} AS {f.ref}" for f in fields))
    return compared.groupBy(*refs).agg(F.expr("count(*) AS n")).where("n > 1")


def duplicate_rows(df: DataFrame, row_id: str | None = None) -> DataFrame:
    """One row: rows equal to an earlier row in every column (NULL and NaN equal).

    Only counts are wanted, so rows are grouped by 128 bits of hash of all cells; nested
    columns, which may have no hash, are grouped as they are.
    """
    t = Table(df, row_id)
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    plain = [f for f in t.fields if not isinstance(f.dtype, nested)]
    rest = [f.ref for f in t.fields if isinstance(f.dtype, nested)]
    marks = ["mark", "mark2"] if plain else []
    rows = t.df.selectExpr(*(_row_key(plain) if plain else []), *rest)
    groups = rows.groupBy(*marks, *rest).agg(F.expr("count(*) AS n"))
    both = groups.agg(F.expr("coalesce(sum(n), 0L) AS total"), F.expr("coalesce(sum(n - 1), 0L) AS repeats"))
    return both.selectExpr(
        "repeats AS duplicate_rows",
        f"{scoring.as_number(scoring.share('repeats', 'total'))} AS duplicate_rows_pct",
    )
