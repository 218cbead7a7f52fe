"""Data-quality profiling, scoring, diagnostics and cleaning on Spark DataFrames."""

from plumbline.functions.scoring import WEIGHTS
from plumbline.operators.batch import (
    CategoriesOutside,
    DuplicateKeys,
    DuplicateRows,
    MissingCounts,
    OutOfRange,
    Snapshot,
    Untrimmed,
    run_batch,
    shared_passes,
)
from plumbline.operators.checks import (
    categories_outside,
    duplicate_key_values,
    duplicate_row_groups,
    health_snapshot,
    missing_counts,
    out_of_range_rows,
    run_checks,
    untrimmed_values,
)
from plumbline.operators.clean import CleanSpec, clean, keep_first, standardize
from plumbline.operators.formats import date_formats
from plumbline.operators.issues import issues_duplicate_key, issues_invalid, issues_log, issues_missing
from plumbline.operators.profile import (
    case_variants,
    column_counts,
    completeness,
    consistency,
    duplicate_rows,
    key_uniqueness,
    padded_values,
    presence,
    validity,
)
from plumbline.operators.sketches import approximate_uniqueness, key_sketches
from plumbline.plans.inspection import Inspection, inspect_csv
from plumbline.plans.profiles import (
    append_profile,
    merge_batches,
    merged_scorecard,
    merged_summary,
    scorecard_with_total,
)
from plumbline.plans.report import (
    dimension_breakdown,
    health_bars,
    issue_drilldown,
    issue_type_counts,
    preview,
    shape,
    write_reports,
)
from plumbline.plans.scorecard import overall_score, scorecard, summary
from plumbline.plans.trend import append_history, breaches, new_breaches, quality_trend, read_history, score_drift
from plumbline.sources.csv import read_csv, write_csv, write_json
from plumbline.sources.footers import completeness_of_files
from plumbline.sources.rows import with_row_id
from plumbline.sources.staging import load_staging, replace_parquet, replace_table
from plumbline.streaming.scores import profile_stream, score_stream, stream_history, stream_scorecard

__all__ = [
    "CategoriesOutside",
    "CleanSpec",
    "DuplicateKeys",
    "DuplicateRows",
    "Inspection",
    "MissingCounts",
    "OutOfRange",
    "Snapshot",
    "Untrimmed",
    "WEIGHTS",
    "append_history",
    "append_profile",
    "approximate_uniqueness",
    "breaches",
    "case_variants",
    "categories_outside",
    "clean",
    "column_counts",
    "completeness",
    "completeness_of_files",
    "consistency",
    "date_formats",
    "dimension_breakdown",
    "duplicate_key_values",
    "duplicate_row_groups",
    "duplicate_rows",
    "health_bars",
    "health_snapshot",
    "inspect_csv",
    "issue_drilldown",
    "issue_type_counts",
    "issues_duplicate_key",
    "issues_invalid",
    "issues_log",
    "issues_missing",
    "keep_first",
    "key_sketches",
    "key_uniqueness",
    "load_staging",
    "merge_batches",
    "merged_scorecard",
    "merged_summary",
    "missing_counts",
    "new_breaches",
    "out_of_range_rows",
    "overall_score",
    "padded_values",
    "presence",
    "preview",
    "profile_stream",
    "quality_trend",
    "read_csv",
    "read_history",
    "replace_parquet",
    "replace_table",
    "run_batch",
    "run_checks",
    "score_drift",
    "score_stream",
    "scorecard",
    "scorecard_with_total",
    "shape",
    "shared_passes",
    "standardize",
    "stream_history",
    "stream_scorecard",
    "summary",
    "untrimmed_values",
    "validity",
    "with_row_id",
    "write_csv",
    "write_json",
    "write_reports",
]
