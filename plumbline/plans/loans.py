"""Loan applications: the example schema, rules, checks and cleaning spec."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.operators import batch, checks
from plumbline.operators.checks import Check
from plumbline.operators.clean import CleanSpec

KEY = "customer_id"

# The loan application layout; dates stay text, their formats are mixed.
LOAN_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("age", T.DoubleType()),
        T.StructField("annual_income", T.DoubleType()),
        T.StructField("credit_score", T.DoubleType()),
        T.StructField("loan_amount", T.DoubleType()),
        T.StructField("existing_loans", T.LongType()),
        T.StructField("region", T.StringType()),
        T.StructField("employment_status", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("marital_status", T.StringType()),
        T.StructField("application_date", T.StringType()),
        T.StructField("default_flag", T.LongType()),
    ]
)

# The default validity rules.
LOAN_RULES = {
    "age": {"min": 18, "max": 100},
    "annual_income": {"min": 0, "max": 1e8},
    "credit_score": {"min": 300, "max": 900},
    "loan_amount": {"min": 0, "max": 1e8},
    "employment_status": {"allowed": ["Employed", "Self-Employed", "Unemployed", "Retired"]},
    "marital_status": {"allowed": ["Single", "Married", "Divorced", "Widowed"]},
}

# The ranges the diagnostic queries look at; narrower than the rules.
AGE_RANGE = {"min": 18, "max": 100}
CREDIT_RANGE = {"min": 300, "max": 900}
SNAPSHOT_RANGES = {"age": AGE_RANGE, "credit_score": CREDIT_RANGE}
ROW_RANGES = {"age": AGE_RANGE, "annual_income": {"min": 0}, "credit_score": CREDIT_RANGE}

LOAN_CLEANING = CleanSpec(
    key=KEY,
    trim=("region", "marital_status"),
    sentence=("employment_status",),
    flag_ranges=ROW_RANGES,
    drop=("gender",),
)


def loan_checks(df: DataFrame) -> dict[str, Check]:
    """The seven diagnostic queries, by name."""
    return {
        "missing_counts": lambda: checks.missing_counts(
            df, ["annual_income", "credit_score", "employment_status", "age"]
        ),
        "duplicate_keys": lambda: checks.duplicate_key_values(df, KEY),
        "duplicate_rows": lambda: checks.duplicate_row_groups(df, LOAN_SCHEMA.fieldNames()),
        "out_of_range": lambda: checks.out_of_range_rows(
            df, ROW_RANGES, ["customer_id", "age", "annual_income", "credit_score"]
        ),
        "category_violations": lambda: checks.categories_outside(
            df, "employment_status", LOAN_RULES["employment_status"]["allowed"]
        ),
        "untrimmed": lambda: checks.untrimmed_values(df, "region"),
        "snapshot": lambda: checks.health_snapshot(
            df, KEY, SNAPSHOT_RANGES, ["annual_income", "credit_score"]
        ),
    }


def loan_batch() -> dict[str, batch.Spec]:
    """The same seven for `run_batch`, which shares its passes among them."""
    return {
        "missing_counts": batch.MissingCounts(["annual_income", "credit_score", "employment_status", "age"]),
        "duplicate_keys": batch.DuplicateKeys(KEY),
        "duplicate_rows": batch.DuplicateRows(LOAN_SCHEMA.fieldNames()),
        "out_of_range": batch.OutOfRange(ROW_RANGES, ["customer_id", "age", "annual_income", "credit_score"]),
        "category_violations": batch.CategoriesOutside(
            "employment_status", LOAN_RULES["employment_status"]["allowed"]
        ),
        "untrimmed": batch.Untrimmed("region"),
        "snapshot": batch.Snapshot(KEY, SNAPSHOT_RANGES, ["annual_income", "credit_score"]),
    }
