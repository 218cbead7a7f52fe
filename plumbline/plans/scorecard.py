"""Counts to scores: the column scorecard, the overall score and the KPIs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scoring
from plumbline.functions.rules import Rules
from plumbline.operators.profile import column_counts

DIMENSION_SCORES = tuple(f"{d}_score" for d in scoring.DIMENSIONS)


def _hundredths(counts: DataFrame, weights: Mapping[str, int]) -> DataFrame:
    dimensions = counts.selectExpr(
        "*",
        f"{scoring.missing_score('missing', 'total')} AS h_completeness",
        f"{scoring.intact_score('duplicate_keys', 'total')} AS h_uniqueness",
        f"{scoring.intact_score('invalid', 'total')} AS h_validity",
        f"{scoring.intact_score('formatting', 'total')} AS h_consistency",
        f"{scoring.share('missing', 'total')} AS h_missing_pct",
        f"{scoring.share('invalid', 'total')} AS h_invalid_pct",
    )
    health = scoring.health({d: f"h_{d}" for d in scoring.DIMENSIONS}, weights)
    return dimensions.selectExpr("*", f"{health} AS h_health")


def score(
    counts: DataFrame, by: Sequence[str] = (), weights: Mapping[str, int] = scoring.WEIGHTS
) -> DataFrame:
    """The scorecard of `column_counts`: lowest health first, ties in column order."""
    names = {
        "completeness": "completeness_score",
        "missing_pct": "missing_pct",
        "uniqueness": "uniqueness_score",
        "validity": "validity_score",
        "invalid_pct": "invalid_pct",
        "consistency": "consistency_score",
        "health": "health_score",
    }
    return (
        _hundredths(counts, weights)
        .orderBy(*by, "h_health", "ordinal")
        .select(
            *by,
            "column",
            *(F.expr(f"{scoring.as_number(f'h_{h}')} AS {shown}") for h, shown in names.items()),
            F.expr(f"{scoring.status('h_health')} AS status"),
        )
    )


def overall(
    counts: DataFrame, by: Sequence[str] = (), weights: Mapping[str, int] = scoring.WEIGHTS
) -> DataFrame:
    """One row (per batch): the unweighted mean of the columns' health scores."""
    return (
        _hundredths(counts, weights)
        .groupBy(*by)
        .agg(F.expr(f"{scoring.as_number(scoring.mean('h_health'))} AS overall_health_score"))
    )


def kpis(
    counts: DataFrame, by: Sequence[str] = (), weights: Mapping[str, int] = scoring.WEIGHTS
) -> DataFrame:
    """One row (per batch): overall score, table shape, and columns per status."""
    status = scoring.status("h_health")
    return (
        _hundredths(counts, weights)
        .groupBy(*by)
        .agg(
            F.expr(f"{scoring.as_number(scoring.mean('h_health'))} AS overall_health_score"),
            F.expr("max(total) AS total_rows"),
            F.expr("count(*) AS total_columns"),
            F.expr(f"count_if({status} = 'Critical') AS columns_critical"),
            F.expr(f"count_if({status} = 'Warning') AS columns_warning"),
            F.expr(f"count_if({status} = 'Good') AS columns_good"),
        )
    )


def scorecard(
    df: DataFrame,
    key: str | None = None,
    rules: Rules | None = None,
    row_id: str | None = None,
    by: Sequence[str] = (),
    weights: Mapping[str, int] = scoring.WEIGHTS,
) -> DataFrame:
    """Profile `df` and score every column."""
    return score(column_counts(df, key, rules, row_id, by), by, weights)


def overall_score(
    df: DataFrame,
    key: str | None = None,
    rules: Rules | None = None,
    row_id: str | None = None,
    by: Sequence[str] = (),
    weights: Mapping[str, int] = scoring.WEIGHTS,
) -> DataFrame:
    return overall(column_counts(df, key, rules, row_id, by), by, weights)


def summary(
    df: DataFrame,
    key: str | None = None,
    rules: Rules | None = None,
    row_id: str | None = None,
    by: Sequence[str] = (),
    weights: Mapping[str, int] = scoring.WEIGHTS,
) -> DataFrame:
    return kpis(column_counts(df, key, rules, row_id, by), by, weights)
