"""Score arithmetic in whole hundredths, as SQL expressions.

Percentages and scores are BIGINT hundredths, rounded half up, and become
doubles only in result tables.  Sums of such integers do not depend on the
order of the rows, so any partitioning gives the same digits.
"""

from __future__ import annotations

from collections.abc import Mapping

DIMENSIONS = ("completeness", "uniqueness", "validity", "consistency")

# Share of each dimension in the health score, in percent.
WEIGHTS = {"completeness": 35, "uniqueness": 15, "validity": 35, "consistency": 15}

# Lowest health score, in hundredths, of each status above Critical.
GOOD_FROM = 9000
WARNING_FROM = 7500


def share(part: str, total: str) -> str:
    """100 * part / total in hundredths, 0 for an empty table."""
    return f"if({total} > 0, (({part}) * 20000L + {total}) div ({total} * 2), 0L)"


def missing_score(missing: str, total: str) -> str:
    """100 minus the already rounded share."""
    return f"10000L - {share(missing, total)}"


def intact_score(bad: str, total: str) -> str:
    """The rounded share of rows that are not bad, 100 for an empty table."""
    return f"if({total} > 0, {share(f'{total} - {bad}', total)}, 10000L)"


def check_weights(weights: Mapping[str, int]) -> None:
    if set(weights) != set(DIMENSIONS) or any(not isinstance(w, int) or w < 0 for w in weights.values()):
        raise ValueError(f"weights must give a whole percent for each of {', '.join(DIMENSIONS)}")


def health(scores: Mapping[str, str], weights: Mapping[str, int] = WEIGHTS) -> str:
    check_weights(weights)
    weighted = " + ".join(f"{weights[d]}L * {scores[d]}" for d in DIMENSIONS)
    return f"({weighted} + 50) div 100"


def status(hundredths: str) -> str:
    return (
        f"CASE WHEN {hundredths} >= {GOOD_FROM} THEN 'Good' "
        f"WHEN {hundredths} >= {WARNING_FROM} THEN 'Warning' ELSE 'Critical' END"
    )


def mean(hundredths: str) -> str:
    """Aggregate: mean of hundredths, rounded half up."""
    return f"(sum({hundredths}) * 2 + count(*)) div (count(*) * 2)"


def as_number(hundredths: str) -> str:
    return f"({hundredths}) / 100.0D"


def as_hundredths(score: str) -> str:
    return f"CAST(round({score} * 100) AS BIGINT)"
