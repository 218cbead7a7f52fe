"""One object that holds a table, its rules and its results; and the whole run over a CSV."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import scoring
from plumbline.functions.rules import Rules
from plumbline.operators.batch import Spec, run_batch
from plumbline.operators.checks import Check, run_checks
from plumbline.operators.clean import CleanSpec, clean
from plumbline.operators.issues import issues_log
from plumbline.operators.profile import column_counts
from plumbline.plans.report import write_reports
from plumbline.plans.scorecard import kpis, overall, score
from plumbline.sources.csv import write_csv
from plumbline.sources.staging import load_staging, replace_table

ROW_ID = "row_index"


@dataclass
class Inspection:
    """Profile a table once and derive every result from the counts.

    `run` computes the counts - one row per column of the table, the only thing
    that reaches the driver - so the scorecard, the overall score and the KPIs
    do not scan the table again.
    """

    df: DataFrame
    key: str | None = None
    rules: Rules = field(default_factory=dict)
    row_id: str | None = None
    weights: Mapping[str, int] = field(default_factory=lambda: dict(scoring.WEIGHTS))
    cap: int | None = None
    _counts: DataFrame | None = field(default=None, repr=False)

    def run(self) -> Inspection:
        counts = column_counts(self.df, self.key, self.rules, self.row_id)
        self._counts = self.df.sparkSession.createDataFrame(counts.collect(), counts.schema)
        return self

    def _ready(self) -> DataFrame:
        if self._counts is None:
            raise RuntimeError("call run() first")
        return self._counts

    def column_scores(self) -> DataFrame:
        return score(self._ready(), weights=self.weights)

    def overall_score(self) -> float:
        return overall(self._ready(), weights=self.weights).first()[0]

    def summary(self) -> DataFrame:
        return kpis(self._ready(), weights=self.weights)

    def issues(self) -> DataFrame:
        self._ready()
        if self.row_id is None:
            raise ValueError("the issues log needs a row_id column")
        return issues_log(self.df, self.row_id, self.key, self.rules, self.cap)

    def write(self, folder: str) -> dict[str, str]:
        return write_reports(self.column_scores(), self.summary(), self.issues(), folder, self.cap is not None)


def inspect_csv(
    spark: SparkSession,
    csv_path: str,
    folder: str,
    key: str | None = None,
    rules: Rules | None = None,
    cleaning: CleanSpec | None = None,
    checks: Callable[[DataFrame], Mapping[str, Check]] | Mapping[str, Spec] | None = None,
    schema: T.StructType | None = None,
    cleaned_table: str | None = None,
    **reading: Any,
) -> dict[str, Any]:
    """From a raw CSV to everything in `folder`.

    staging/ (Parquet with row positions), reports/ (scorecard, summary, issues),
    checks/<label>/ and cleaned/ (CSV; also the table `cleaned_table`, replaced, if
    named).  Checks given as a batch of specs share their passes over the table.  The CSV is parsed into staging once, with the options `reading` of
    `read_csv`, and all else reads staging.  A key the table lacks is ignored.
    """
    staged = load_staging(spark, csv_path, path=f"{folder}/staging", schema=schema, row_id=ROW_ID, **reading)
    inspection = Inspection(staged, key, rules or {}, ROW_ID).run()
    result: dict[str, Any] = {
        "summary": inspection.summary().first().asDict(),
        "reports": inspection.write(f"{folder}/reports"),
    }
    if checks is not None:
        data = staged.drop(ROW_ID)
        if callable(checks):
            result["checks"] = run_checks(spark, checks(data), f"{folder}/checks")
        else:
            result["checks"] = run_batch(data, checks, f"{folder}/checks")
    if cleaning is not None:
        spec = replace(cleaning, drop=(*cleaning.drop, ROW_ID))
        written = Observation("cleaned")
        cleaned = clean(staged, spec, ROW_ID).observe(written, F.count(F.lit(1)).alias("rows"))
        result["cleaned"] = write_csv(cleaned, f"{folder}/cleaned")
        result["cleaned_rows"] = written.get["rows"]
        if cleaned_table is not None:
            result["cleaned_table"] = replace_table(clean(staged, spec, ROW_ID), cleaned_table)
    return result
