"""Published counts in, published scores out."""

import pytest
from plumbline.functions import scoring
from plumbline.plans.scorecard import kpis, overall, score

TOTAL = 2030

# column, missing, repeated keys, invalid, formatting, then the expected scores and status
GOLDEN = [
    ("customer_id", 0, 30, 0, 0, 100.0, 98.52, 100.0, 100.0, 99.78, "Good"),
    ("age", 41, 0, 15, 0, 97.98, 100.0, 99.26, 100.0, 99.03, "Good"),
    ("annual_income", 119, 0, 22, 0, 94.14, 100.0, 98.92, 100.0, 97.57, "Good"),
    ("credit_score", 80, 0, 15, 0, 96.06, 100.0, 99.26, 100.0, 98.36, "Good"),
    ("loan_amount", 0, 0, 12, 0, 100.0, 100.0, 99.41, 100.0, 99.79, "Good"),
    ("existing_loans", 0, 0, 0, 0, 100.0, 100.0, 100.0, 100.0, 100.0, "Good"),
    ("region", 0, 0, 0, 20, 100.0, 100.0, 100.0, 99.01, 99.85, "Good"),
    ("employment_status", 62, 0, 0, 0, 96.95, 100.0, 100.0, 100.0, 98.93, "Good"),
    ("gender", 0, 0, 0, 1567, 100.0, 100.0, 100.0, 22.81, 88.42, "Warning"),
    ("marital_status", 0, 0, 0, 0, 100.0, 100.0, 100.0, 100.0, 100.0, "Good"),
    ("application_date", 0, 0, 0, 0, 100.0, 100.0, 100.0, 100.0, 100.0, "Good"),
    ("default_flag", 0, 0, 0, 0, 100.0, 100.0, 100.0, 100.0, 100.0, "Good"),
]

ORDER = ["gender", "annual_income", "credit_score", "employment_status", "age", "customer_id"]
ORDER += ["loan_amount", "region", "existing_loans", "marital_status", "application_date", "default_flag"]

COUNTS_SCHEMA = (
    "ordinal int, column string, total long, missing long, invalid long, duplicate_keys long, formatting long"
)


def counts_frame(spark, rows):
    return spark.createDataFrame(rows, COUNTS_SCHEMA)


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(i, c, TOTAL, miss, bad, dup, fmt) for i, (c, miss, dup, bad, fmt, *_) in enumerate(GOLDEN)]
    return counts_frame(spark, rows)


def test_published_scores(golden):
    card = score(golden).collect()
    expected = {c: tuple(rest) for c, _, _, _, _, *rest in GOLDEN}
    for r in card:
        assert (
            r.completeness_score,
            r.uniqueness_score,
            r.validity_score,
            r.consistency_score,
            r.health_score,
            r.status,
        ) == expected[r.column]
    assert [r.column for r in card] == ORDER
    assert {r.column: (r.missing_pct, r.invalid_pct) for r in card}["annual_income"] == (5.86, 1.08)


def test_published_summary(golden):
    assert overall(golden).first()[0] == 98.48
    assert tuple(kpis(golden).first()) == (98.48, 2030, 12, 0, 1, 11)


def test_bands(spark):
    # completeness weighs 35 of 100: 7143 missing of 10000 leave 75.0, 7144 leave less
    rows = [(0, "a", 10000, 2857, 0, 0, 0), (1, "b", 10000, 2858, 0, 0, 0), (2, "c", 10000, 7143, 0, 0, 0)]
    rows += [(3, "d", 10000, 7144, 0, 0, 0)]
    got = {r.column: (r.health_score, r.status) for r in score(counts_frame(spark, rows)).collect()}
    assert got == {"a": (90.0, "Good"), "b": (90.0, "Good"), "c": (75.0, "Warning"), "d": (75.0, "Warning")}
    rows = [(0, "a", 10000, 2860, 0, 0, 0), (1, "b", 10000, 7145, 0, 0, 0)]
    got = {r.column: (r.health_score, r.status) for r in score(counts_frame(spark, rows)).collect()}
    assert got == {"a": (89.99, "Warning"), "b": (74.99, "Critical")}


def test_huge_counts_do_not_overflow(spark):
    total = 10**14
    rows = [(0, "a", total, total // 4, total // 2, total // 3, total // 7)]
    r = score(counts_frame(spark, rows)).first()
    assert (r.missing_pct, r.invalid_pct, r.uniqueness_score, r.consistency_score) == (25.0, 50.0, 66.67, 85.71)


def test_weights(golden):
    only = {"completeness": 0, "uniqueness": 0, "validity": 0, "consistency": 100}
    assert score(golden, weights=only).first().health_score == 22.81
    for wrong in ({"completeness": 100}, {**scoring.WEIGHTS, "validity": 0.35}):
        with pytest.raises(ValueError):
            score(golden, weights=wrong)
