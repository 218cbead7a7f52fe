"""The hand-computed loan table: every operator against values worked out on paper."""

import pytest
from plumbline import (
    Inspection,
    breaches,
    case_variants,
    clean,
    completeness,
    consistency,
    date_formats,
    dimension_breakdown,
    duplicate_rows,
    health_bars,
    issue_drilldown,
    issue_type_counts,
    issues_log,
    keep_first,
    key_uniqueness,
    overall_score,
    padded_values,
    preview,
    run_checks,
    scorecard,
    shape,
    summary,
    validity,
)
from plumbline.plans.loans import KEY, LOAN_CLEANING, LOAN_RULES, loan_checks

# column: completeness, uniqueness, validity, consistency, health, status
EXPECTED = {
    "customer_id": (75.0, 75.0, 100.0, 100.0, 87.5, "Warning"),
    "age": (87.5, 100.0, 75.0, 100.0, 86.88, "Warning"),
    "annual_income": (87.5, 100.0, 87.5, 100.0, 91.25, "Good"),
    "credit_score": (87.5, 100.0, 75.0, 100.0, 86.88, "Warning"),
    "loan_amount": (100.0, 100.0, 87.5, 100.0, 95.63, "Good"),
    "existing_loans": (100.0, 100.0, 100.0, 100.0, 100.0, "Good"),
    "region": (100.0, 100.0, 100.0, 50.0, 92.5, "Good"),
    "employment_status": (87.5, 100.0, 87.5, 75.0, 87.5, "Warning"),
    "gender": (100.0, 100.0, 100.0, 62.5, 94.38, "Good"),
    "marital_status": (100.0, 100.0, 87.5, 62.5, 90.0, "Good"),
    "application_date": (100.0, 100.0, 100.0, 100.0, 100.0, "Good"),
    "default_flag": (100.0, 100.0, 100.0, 100.0, 100.0, "Good"),
}

ISSUES = (
    [(6, "customer_id", "missing_value"), (7, "customer_id", "missing_value"), (1, "age", "missing_value")]
    + [(2, "annual_income", "missing_value"), (4, "credit_score", "missing_value")]
    + [(4, "employment_status", "missing_value")]
    + [(i, "customer_id", "duplicate_key") for i in (0, 3, 6, 7)]
    + [(2, "age", "invalid_value"), (5, "age", "invalid_value"), (4, "annual_income", "invalid_value")]
    + [(1, "credit_score", "invalid_value"), (7, "credit_score", "invalid_value")]
    + [(2, "loan_amount", "invalid_value")]
)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_scorecard(loans):
    card = scorecard(loans, KEY, LOAN_RULES, row_id="row_id")
    got = {
        r.column: (
            r.completeness_score,
            r.uniqueness_score,
            r.validity_score,
            r.consistency_score,
            r.health_score,
            r.status,
        )
        for r in card.collect()
    }
    assert got == EXPECTED
    ordered = [r.column for r in card.collect()]
    assert ordered == sorted(EXPECTED, key=lambda c: (EXPECTED[c][4], list(EXPECTED).index(c)))
    by_name = {r.column: r for r in card.collect()}
    assert by_name["age"].missing_pct == 12.5
    assert by_name["age"].invalid_pct == 25.0


def test_overall_and_summary(loans):
    assert rows(overall_score(loans, KEY, LOAN_RULES, "row_id")) == [(92.71,)]
    kpis = summary(loans, KEY, LOAN_RULES, "row_id")
    assert kpis.columns == [
        "overall_health_score",
        "total_rows",
        "total_columns",
        "columns_critical",
        "columns_warning",
        "columns_good",
    ]
    assert rows(kpis) == [(92.71, 8, 12, 0, 4, 8)]


def test_dimensions_alone(loans):
    assert {r.column: r.missing_count for r in completeness(loans, "row_id").collect()} == {
        "customer_id": 2,
        "age": 1,
        "annual_income": 1,
        "credit_score": 1,
        "employment_status": 1,
    } | {c: 0 for c in ("loan_amount", "existing_loans", "region", "gender", "marital_status")} | {
        "application_date": 0,
        "default_flag": 0,
    }
    assert rows(duplicate_rows(loans, "row_id")) == [(1, 12.5)]
    assert rows(key_uniqueness(loans, KEY)) == [("customer_id", 2, 75.0)]
    assert {r.column: (r.invalid_count, r.validity_score) for r in validity(loans, LOAN_RULES).collect()} == {
        "age": (2, 75.0),
        "annual_income": (1, 87.5),
        "credit_score": (2, 75.0),
        "loan_amount": (1, 87.5),
        "employment_status": (1, 87.5),
        "marital_status": (1, 87.5),
    }
    assert {r.column: r.formatting_issue_count for r in consistency(loans).collect()} == {
        "region": 4,
        "employment_status": 2,
        "gender": 3,
        "marital_status": 3,
        "application_date": 0,
    }
    assert {r.column: r.padded_count for r in padded_values(loans).collect()} == {
        "region": 1,
        "employment_status": 1,
        "gender": 0,
        "marital_status": 0,
        "application_date": 0,
    }
    assert {r.column: (r.variant_values, r.variant_rows) for r in case_variants(loans).collect()} == {
        "region": (1, 3),
        "employment_status": (1, 2),
        "gender": (1, 3),
        "marital_status": (1, 3),
        "application_date": (0, 0),
    }


def test_issues(loans):
    assert rows(issues_log(loans, "row_id", KEY, LOAN_RULES, cap=50)) == ISSUES
    assert sorted(rows(issues_log(loans, "row_id", KEY, LOAN_RULES))) == sorted(ISSUES)


def test_checks(loans, spark):
    got = {k: rows(v) for k, v in run_checks(spark, loan_checks(loans)).items()}
    assert got["missing_counts"] == [(1, 1, 1, 1, 8)]
    assert got["duplicate_keys"] == [(None, 2), (1, 2)]
    assert got["duplicate_rows"] == [
        (1, 25.0, 5e5, 700.0, 1e5, 0, "North", "Employed", "Male", "Single", "2023-01-01", 0, 2)
    ]
    assert sorted(r[1:3] for r in got["out_of_range"] if r[1] is not None) == sorted(
        [(-5.0, None), (40.0, -1e5), (101.0, 1e8), (100.0, 7e5)]
    )
    assert len(got["out_of_range"]) == 5
    assert got["category_violations"] == [("Student",)]
    assert got["untrimmed"] == [("South  ",)]
    assert got["snapshot"] == [(8, 2, 4, 2)]


def test_clean(loans):
    kept = keep_first(loans, KEY, "row_id")
    assert kept.columns == loans.columns
    assert sorted(r.row_id for r in kept.collect()) == [0, 1, 2, 4, 5, 6]
    cleaned = clean(loans, LOAN_CLEANING, "row_id").orderBy("row_id").collect()
    assert [r.is_flagged_invalid for r in cleaned] == [0, 1, 1, 1, 1, 0]
    assert [r.employment_status for r in cleaned] == [
        "Employed",
        "Self-employed",
        "Self-employed",
        None,
        "Student",
        "Retired",
    ]
    assert [r.region for r in cleaned] == ["North", "South", "East", "West", "north", "Central"]
    assert "gender" not in cleaned[0].asDict()


def test_duplicate_rows(loans):
    assert rows(duplicate_rows(loans, "row_id")) == [(1, 12.5)]


def test_reports(loans):
    card = scorecard(loans, KEY, LOAN_RULES, row_id="row_id")
    log = issues_log(loans, "row_id", KEY, LOAN_RULES)
    assert rows(health_bars(card))[0] == ("age", 86.88, "Warning")
    long = dimension_breakdown(card)
    assert long.count() == 48
    assert rows(long.where("column = 'gender' and dimension = 'consistency_score'")) == [
        ("gender", "consistency_score", 62.5)
    ]
    drill = rows(issue_drilldown(card, log, "age"))
    assert sorted(drill) == [
        (1, "age", "missing_value", 86.88, "Warning"),
        (2, "age", "invalid_value", 86.88, "Warning"),
        (5, "age", "invalid_value", 86.88, "Warning"),
    ]
    assert issue_drilldown(card, log).count() == 16
    assert rows(issue_type_counts(log)) == [("invalid_value", 6), ("missing_value", 6), ("duplicate_key", 4)]
    assert rows(shape(loans.drop("row_id"))) == [(8, 12)]
    assert [r.row_id for r in preview(loans, "row_id").collect()] == [0, 1, 2, 3, 4]
    assert {r.column for r in breaches(card, 87.0).collect()} == {"age", "credit_score"}


def test_date_formats(loans):
    got = {r.date_format: r.n_rows for r in date_formats(loans, ["application_date"]).collect()}
    assert got == {"yyyy-MM-dd": 5, "dd-MMM-yyyy": 1, "ambiguous": 2}


def test_date_format_labels(spark):
    values = ["2024-01-31", "31/01/2024", "01/31/2024", "05/06/2024", "31/31/2024", "7-Mar-2024", "07-Mar-2024"]
    df = spark.createDataFrame([(v,) for v in [*values, "soon", None]], "d string")
    got = {r.date_format: r.n_rows for r in date_formats(df, ["d"]).collect()}
    assert got == {
        "yyyy-MM-dd": 1,
        "dd/MM/yyyy": 1,
        "MM/dd/yyyy": 1,
        "ambiguous": 1,
        "dd-MMM-yyyy": 1,
        "other": 3,
        "missing": 1,
    }


def test_inspection(loans):
    inspection = Inspection(loans, KEY, LOAN_RULES, "row_id")
    with pytest.raises(RuntimeError):
        inspection.summary()
    inspection.run()
    assert inspection.overall_score() == 92.71
    assert rows(inspection.summary()) == [(92.71, 8, 12, 0, 4, 8)]
    assert sorted(rows(inspection.issues())) == sorted(ISSUES)
    assert [r.column for r in inspection.column_scores().collect()][0] == "age"


def test_any_partitioning_gives_the_same(loans):
    def results(df):
        return (
            rows(scorecard(df, KEY, LOAN_RULES, "row_id")),
            rows(issues_log(df, "row_id", KEY, LOAN_RULES, cap=50)),
            sorted(map(str, rows(clean(df, LOAN_CLEANING, "row_id")))),
        )

    assert results(loans.repartition(1)) == results(loans.repartition(7)) == results(loans.orderBy("row_id"))
