"""Labelled batches of checks that share their passes over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.rules import Rules
from plumbline.functions.values import nan_to_null, orderable
from plumbline.operators.checks import any_outside, required_fields
from plumbline.operators.profile import repeated_rows
from plumbline.operators.table import Field, Table


@dataclass(frozen=True)
class MissingCounts:
    """One wide row: missing_<column> for each column, and total_rows."""

    columns: Sequence[str]


@dataclass(frozen=True)
class DuplicateKeys:
    """Key values that occur more than once, with occurrence_count."""

    key: str


@dataclass(frozen=True)
class DuplicateRows:
    """Rows that occur more than once over `columns` (all by default), with dup_count."""

    columns: Sequence[str] | None = None


@dataclass(frozen=True)
class OutOfRange:
    """Rows with any value outside its range, projected to `columns`."""

    ranges: Rules
    columns: Sequence[str]


@dataclass(frozen=True)
class CategoriesOutside:
    """Distinct raw values whose trimmed lower-case form is not allowed."""

    column: str
    allowed: Sequence[str]


@dataclass(frozen=True)
class Untrimmed:
    """Distinct raw values with spaces around them."""

    column: str


@dataclass(frozen=True)
class Snapshot:
    """One row of counts: rows, repeated key values, out-of-range rows, incomplete rows."""

    key: str
    ranges: Rules = field(default_factory=dict)
    required: Sequence[str] = ()


Spec = MissingCounts | DuplicateKeys | DuplicateRows | OutOfRange | CategoriesOutside | Untrimmed | Snapshot


class _Batch:
    """The checks of a batch sorted by what they group by; each grouping becomes one `pass`, shared by its checks.

    A pass is a small table: what all its checks need, and no more. Passes are global sums (these ride along with a
    grouping by key, if there is one), groups of one key, distinct values of text columns, and rows out of range.
    """

    def __init__(self, df: DataFrame, checks: Mapping[str, Spec]):
        self.t = Table(df)
        self.checks: dict[str, Spec] = {}
        self.errors: dict[str, str] = {}
        for label, spec in checks.items():
            try:
                self._check(spec)
                self.checks[label] = spec
            except ValueError as error:
                self.errors[f"{label}_error"] = str(error)
        self.labels = {label: i for i, label in enumerate(self.checks)}
        self.keys = list(dict.fromkeys(s.key for s in self._of(DuplicateKeys, Snapshot).values()))
        self.passes = self._passes()

    def _of(self, *kinds: type) -> dict[str, Spec]:
        return {label: spec for label, spec in self.checks.items() if isinstance(spec, kinds)}

    def _check(self, spec: Spec) -> None:
        names = list(getattr(spec, "columns", None) or []) + list(getattr(spec, "ranges", []))
        names += [getattr(spec, a) for a in ("key", "column") if hasattr(spec, a)] + list(getattr(spec, "required", []))
        fields = required_fields(self.t, names)
        if hasattr(spec, "key"):
            fields[names.index(spec.key)].comparable("check")

    def _field(self, name: str) -> Field:
        return required_fields(self.t, [name])[0]

    def _sums(self, key: str | None) -> dict[str, object]:
        """Name -> predicate of all rows counted together with a grouping: missing cells and parts of snapshots."""
        out = {}
        if key == (self.keys[0] if self.keys else None):
            for spec in self._of(MissingCounts).values():
                out |= {f"missing_{f.ref}": f.missing for f in required_fields(self.t, spec.columns)}
        for label, spec in self._of(Snapshot).items():
            if spec.key == key:
                missing = [f.missing for f in required_fields(self.t, spec.required)]
                out[f"invalid_{self.labels[label]}"] = any_outside(self.t, spec.ranges)
                out[f"incomplete_{self.labels[label]}"] = reduce(or_, missing, F.lit(False))
        return out

    def _passes(self) -> dict[str, DataFrame]:
        passes = {f"key_{i}": self._by_key(key) for i, key in enumerate(self.keys)}
        if self._of(MissingCounts) and not self.keys:
            sums = [F.count_if(test).alias(name) for name, test in self._sums(None).items()]
            passes["all"] = self.t.df.agg(F.count("*").alias("total"), *sums)
        if self._of(CategoriesOutside, Untrimmed):
            passes["values"] = self._values()
        if self._of(OutOfRange):
            passes["rows"] = self._rows()
        for columns in dict.fromkeys(self._duplicated(s) for s in self._of(DuplicateRows).values()):
            name = f"rows_{'_'.join(str(self._field(c).ordinal) for c in columns)}"
            passes[name] = repeated_rows(self.t, required_fields(self.t, columns))
        return passes

    def _duplicated(self, spec: DuplicateRows) -> tuple[str, ...]:
        return tuple(spec.columns if spec.columns is not None else self.t.names)

    def _by_key(self, key: str) -> DataFrame:
        """The repeated values of a key with their counts `n`, and in one row without `n` the sums over all rows."""
        f = self._field(key)
        sums = self._sums(key)
        rows = self.t.df.select(
            F.expr(nan_to_null(f.ref, f.dtype)).alias("value"), *(F.when(p, 1).otherwise(0).alias(s) for s, p in sums.items())
        )
        groups = rows.groupBy("value").agg(F.count("*").alias("n"), *(F.sum(s).alias(s) for s in sums))
        totals = ", ".join(["n AS total", *sums])
        none = ", ".join(["CAST(NULL AS BIGINT) AS total", *(f"CAST(NULL AS BIGINT) AS {s}" for s in sums)])
        kind = self.t.df.select(F.expr(nan_to_null(f.ref, f.dtype)).alias("value")).schema["value"].dataType.simpleString()
        # Every group adds to the sums; one with several rows is also kept for itself.
        parts = groups.selectExpr(
            f"inline(if(n > 1, array(struct(false AS whole, value, n, {none}),"
            f" struct(true AS whole, CAST(NULL AS {kind}) AS value, CAST(NULL AS BIGINT) AS n, {totals})),"
            f" array(struct(true AS whole, CAST(NULL AS {kind}) AS value, CAST(NULL AS BIGINT) AS n, {totals}))))"
        )
        return parts.groupBy("whole", "value", "n").agg(
            F.sum("total").alias("total"), *(F.sum(s).alias(s) for s in sums)
        )

    def _values(self) -> DataFrame:
        """Distinct values of the text columns that fail any of the checks, with the labels' numbers they fail."""
        tests = []
        for label, spec in self._of(CategoriesOutside, Untrimmed).items():
            f = self._field(spec.column)
            bad = F.col("value") != F.trim("value")
            if isinstance(spec, CategoriesOutside):
                bad = ~F.lower(F.trim("value")).isin([a.lower() for a in spec.allowed])
            tests.append(F.when((F.col("ref") == f.ref) & bad, F.lit(self.labels[label])))
        refs = list(dict.fromkeys(self._field(s.column).ref for s in self._of(CategoriesOutside, Untrimmed).values()))
        cells = self.t.df.selectExpr(*(f"CAST({r} AS STRING) AS {r}" for r in refs)).unpivot([], refs, "ref", "value")
        values = cells.where("value IS NOT NULL").distinct()
        return values.select("ref", "value", F.array_compact(F.array(*tests)).alias("failed")).where("size(failed) > 0")

    def _rows(self) -> DataFrame:
        """Rows that fail any of the range checks, with the numbers of those they fail."""
        specs = self._of(OutOfRange)
        tests = {self.labels[label]: any_outside(self.t, spec.ranges) for label, spec in specs.items()}
        shown = {f.ref for spec in specs.values() for f in required_fields(self.t, spec.columns)}
        failed = F.array_compact(F.array(*(F.when(test, F.lit(i)) for i, test in tests.items())))
        return self.t.df.where(reduce(or_, tests.values())).select(*sorted(shown), failed.alias("failed"))

    def result(self, label: str, passes: Mapping[str, DataFrame]) -> DataFrame:
        """The answer of one check, from the passes."""
        spec, number = self.checks[label], F.lit(self.labels[label])
        if isinstance(spec, MissingCounts):
            rows = passes["key_0"].where("whole") if self.keys else passes["all"]
            fields = required_fields(self.t, spec.columns)
            # As SQL has it, the sums of a table without rows are NULL.
            seen = F.when(F.sum("total") > 0, F.lit(1))
            return rows.agg(
                *((F.sum(f"missing_{f.ref}") * seen).alias(f"missing_{f.name}") for f in fields),
                F.coalesce(F.sum("total"), F.lit(0).cast("long")).alias("total_rows"),
            )
        if isinstance(spec, (DuplicateKeys, Snapshot)):
            rows = passes[f"key_{self.keys.index(spec.key)}"]
            if isinstance(spec, DuplicateKeys):
                groups = rows.where("NOT whole").select("value", "n")
                groups = groups.orderBy(F.desc("n"), "value") if orderable(groups.schema["value"].dataType) else groups
                return groups.toDF(spec.key, "occurrence_count")
            zero = F.lit(0).cast("long")
            i = self.labels[label]
            return rows.agg(
                F.coalesce(F.sum("total"), zero).alias("total_rows"),
                F.count_if(~F.col("whole")).alias(f"duplicate_{spec.key}s"),
                F.coalesce(F.sum(f"invalid_{i}"), zero).alias("invalid_value_rows"),
                F.coalesce(F.sum(f"incomplete_{i}"), zero).alias("incomplete_rows"),
            )
        if isinstance(spec, DuplicateRows):
            fields = required_fields(self.t, self._duplicated(spec))
            groups = passes[f"rows_{'_'.join(str(f.ordinal) for f in fields)}"]
            return groups.select(*(f.col.alias(f.name) for f in fields), F.col("n").alias("dup_count"))
        if isinstance(spec, OutOfRange):
            rows = passes["rows"].where(F.array_contains("failed", number))
            return rows.select(*(f.col.alias(f.name) for f in required_fields(self.t, spec.columns)))
        return passes["values"].where(F.array_contains("failed", number)).select(F.col("value").alias(spec.column))


def shared_passes(df: DataFrame, checks: Mapping[str, Spec]) -> dict[str, DataFrame]:
    """The passes that a batch makes over the table, one for each different grouping, still to be run."""
    return _Batch(df, checks).passes


def run_batch(df: DataFrame, checks: Mapping[str, Spec], folder: str) -> dict[str, DataFrame | str]:
    """Runs a labelled batch of checks with one pass over the table for each different grouping among them.

    What a pass finds is written below `folder` and every answer is read from there; the rows are those of the
    functions of the same kind. A check that cannot be planned yields `<label>_error`, and so do the checks of a
    pass that fails as it runs; the others are not stopped.
    """
    batch = _Batch(df, checks)
    spark = df.sparkSession
    results: dict[str, DataFrame | str] = {}
    done: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for name, frame in batch.passes.items():
        try:
            frame.write.mode("overwrite").parquet(f"{folder}/{name}")
            done[name] = spark.read.schema(frame.schema).parquet(f"{folder}/{name}")
        except Exception as error:  # whatever stops one pass must not stop the others
            failed[name] = str(error)
    for label in batch.checks:
        try:
            results[label] = batch.result(label, done)
        except KeyError as missing:
            results[f"{label}_error"] = failed[missing.args[0]]
    return results | batch.errors
