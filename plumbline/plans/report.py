"""Result tables for dashboards, and their files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.values import quoted
from plumbline.plans.scorecard import DIMENSION_SCORES
from plumbline.sources.csv import write_csv, write_json


def health_bars(scorecard: DataFrame) -> DataFrame:
    """column, health_score, status - lowest first."""
    return scorecard.select("column", "health_score", "status").orderBy("health_score", "column")


def dimension_breakdown(scorecard: DataFrame) -> DataFrame:
    """The four dimension scores of each column in long form."""
    return scorecard.unpivot(["column"], list(DIMENSION_SCORES), "dimension", "score")


def issue_drilldown(
    scorecard: DataFrame, issues: DataFrame, column: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Logged rows beside their column's score; `column` selects one bar.

    A scorecard of batches, and issues that carry the same columns, are joined on `by` too.
    """
    picked = issues if column is None else issues.where(F.col("column") == column)
    scores = scorecard.select(*by, "column", "health_score", "status")
    others = scorecard.columns[: scorecard.columns.index("column")]
    if set(others) != set(by):
        raise ValueError(f"the scorecard has the batch columns {others}; name them in `by`")
    return picked.join(scores, [*by, "column"]).select(
        *by, "row_index", "column", "issue_type", "health_score", "status"
    )


def issue_type_counts(issues: DataFrame) -> DataFrame:
    """Logged rows per kind of issue, most frequent first."""
    return (
        issues.groupBy("issue_type")
        .agg(F.count("*").alias("n_issues"))
        .orderBy(F.desc("n_issues"), "issue_type")
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def preview(df: DataFrame, row_id: str, n: int = 5) -> DataFrame:
    """The first `n` rows."""
    return df.orderBy(F.col(quoted(row_id))).limit(n)


def write_reports(
    scorecard: DataFrame, summary: DataFrame, issues: DataFrame, folder: str, one_issues_file: bool = False
) -> dict[str, str]:
    """The three results a dashboard imports.

    One file each for the scorecard, which has a row per column, and the summary,
    which has one row; the issues log is a folder of files unless it is capped.
    """
    return {
        "scorecard": write_csv(scorecard, f"{folder}/column_health_scorecard", single_file=True),
        "summary": write_json(summary, f"{folder}/overall_summary"),
        "issues": write_csv(issues, f"{folder}/issues_log", single_file=one_issues_file),
    }
