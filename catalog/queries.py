"""Every registered query: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import plumbline as pl
from catalog import views
from plumbline.functions.rules import Rules
from plumbline.plans.loans import KEY as LOAN_KEY
from plumbline.plans.loans import LOAN_CLEANING, LOAN_RULES, LOAN_SCHEMA, loan_batch, loan_checks
from plumbline.sources.shared import shared_folder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

CUSTOMER_KEY = "c_custkey"
CUSTOMER_REQUIRED = ["c_acctbal", "c_mktsegment"]
CUSTOMER_RANGES = {c: views.CUSTOMER_RULES[c] for c in ("c_acctbal", "c_nationkey")}
SNAPSHOT_RANGES = {"c_acctbal": views.CUSTOMER_RULES["c_acctbal"]}
CUSTOMER_CLEANING = pl.CleanSpec(
    key=CUSTOMER_KEY,
    trim=("c_name",),
    sentence=("c_mktsegment",),
    flag_ranges=CUSTOMER_RANGES,
    drop=("row_id", "c_name"),
)

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _customer_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.scorecard(views.dirty_customer(spark, sf_dir), CUSTOMER_KEY, views.CUSTOMER_RULES, "row_id")


def _customer_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.issues_log(views.dirty_customer(spark, sf_dir), "row_id", CUSTOMER_KEY, views.CUSTOMER_RULES)


# --- dimensions -----------------------------------------------------------


@query
def completeness(spark, sf_dir):
    return pl.completeness(views.dirty_customer(spark, sf_dir), "row_id")


@query
def completeness_left_join(spark, sf_dir):
    return pl.completeness(views.labelled_documents(spark, sf_dir))


@query
def duplicate_rows(spark, sf_dir):
    return pl.duplicate_rows(views.dirty_customer(spark, sf_dir), "row_id")


@query
def duplicate_rows_lineitem(spark, sf_dir):
    return pl.duplicate_rows(views.table(spark, sf_dir, "lineitem"))


@query
def key_uniqueness(spark, sf_dir):
    return pl.key_uniqueness(views.dirty_customer(spark, sf_dir), CUSTOMER_KEY, "row_id")


@query
def key_uniqueness_lineitem(spark, sf_dir):
    return pl.key_uniqueness(views.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def key_uniqueness_documents(spark, sf_dir):
    return pl.key_uniqueness(views.table(spark, sf_dir, "documents"), "text")


@query
def validity_range(spark, sf_dir):
    return pl.validity(views.dirty_customer(spark, sf_dir), CUSTOMER_RANGES, "row_id")


@query
def validity_allowed(spark, sf_dir):
    rules = {"c_mktsegment": views.CUSTOMER_RULES["c_mktsegment"]}
    return pl.validity(views.dirty_customer(spark, sf_dir), rules, "row_id")


@query
def validity(spark, sf_dir):
    return pl.validity(views.dirty_customer(spark, sf_dir), views.CUSTOMER_RULES, "row_id")


@query
def validity_lineitem(spark, sf_dir):
    return pl.validity(views.table(spark, sf_dir, "lineitem"), views.LINEITEM_RULES)


@query
def padded_values(spark, sf_dir):
    return pl.padded_values(views.dirty_customer(spark, sf_dir), row_id="row_id")


@query
def case_variants(spark, sf_dir):
    return pl.case_variants(views.dirty_customer(spark, sf_dir), row_id="row_id")


@query
def consistency(spark, sf_dir):
    return pl.consistency(views.dirty_customer(spark, sf_dir), row_id="row_id")


@query
def consistency_part(spark, sf_dir):
    return pl.consistency(views.dirty_part(spark, sf_dir), row_id="row_id")


@query
def consistency_documents(spark, sf_dir):
    return pl.consistency(views.table(spark, sf_dir, "documents"))


# --- scores ---------------------------------------------------------------


@query
def scorecard(spark, sf_dir):
    return _customer_card(spark, sf_dir)


@query
def overall_score(spark, sf_dir):
    return pl.overall_score(views.dirty_customer(spark, sf_dir), CUSTOMER_KEY, views.CUSTOMER_RULES, "row_id")


@query
def summary(spark, sf_dir):
    return pl.summary(views.dirty_customer(spark, sf_dir), CUSTOMER_KEY, views.CUSTOMER_RULES, "row_id")


def _whole_table_card(name: str, key: str, rules: Rules) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pl.scorecard(views.table(spark, sf_dir, name), key, rules)

    return run


WHOLE_TABLES = {
    "orders": ("o_custkey", views.ORDER_RULES),
    "lineitem": ("l_orderkey", views.LINEITEM_RULES),
    "events": ("event_id", views.EVENT_RULES),
    "documents": ("text", views.DOCUMENT_RULES),
}
for _name, (_key, _rules) in WHOLE_TABLES.items():
    _QUERIES[f"scorecard_{_name}"] = _whole_table_card(_name, _key, _rules)


@query
def scorecard_part(spark, sf_dir):
    return pl.scorecard(views.dirty_part(spark, sf_dir), "p_partkey", views.PART_RULES, "row_id")


# --- issues ---------------------------------------------------------------


@query
def issues_missing(spark, sf_dir):
    return pl.issues_missing(views.dirty_customer(spark, sf_dir), "row_id")


@query
def issues_duplicate_key(spark, sf_dir):
    return pl.issues_duplicate_key(views.dirty_customer(spark, sf_dir), "row_id", CUSTOMER_KEY)


@query
def issues_invalid(spark, sf_dir):
    return pl.issues_invalid(views.dirty_customer(spark, sf_dir), "row_id", views.CUSTOMER_RULES)


@query
def issues_log(spark, sf_dir):
    return _customer_issues(spark, sf_dir)


@query
def issues_log_orders(spark, sf_dir):
    return pl.issues_log(views.table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", views.ORDER_RULES)


# --- diagnostic queries ---------------------------------------------------


def _customer_checks(df: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    data = df.drop("row_id")
    return {
        "missing_counts": lambda: pl.missing_counts(data, [CUSTOMER_KEY, *CUSTOMER_REQUIRED, "c_name"]),
        "duplicate_keys": lambda: pl.duplicate_key_values(data, CUSTOMER_KEY),
        "duplicate_rows": lambda: pl.duplicate_row_groups(data),
        "out_of_range": lambda: pl.out_of_range_rows(
            data, CUSTOMER_RANGES, [CUSTOMER_KEY, "c_acctbal", "c_nationkey"]
        ),
        "category_violations": lambda: pl.categories_outside(data, "c_mktsegment", list(views.SEGMENTS)),
        "untrimmed": lambda: pl.untrimmed_values(data, "c_mktsegment"),
        "snapshot": lambda: pl.health_snapshot(data, CUSTOMER_KEY, SNAPSHOT_RANGES, CUSTOMER_REQUIRED),
    }


def _check(view: Callable, checks: Callable, label: str) -> Query:
    return lambda spark, sf_dir: checks(view(spark, sf_dir))[label]()


CHECK_LABELS = (
    "missing_counts",
    "duplicate_keys",
    "duplicate_rows",
    "out_of_range",
    "category_violations",
    "untrimmed",
    "snapshot",
)
for _label in CHECK_LABELS:
    _QUERIES[f"sql_{_label}"] = _check(views.dirty_customer, _customer_checks, _label)
    _QUERIES[f"loan_{_label}"] = _check(views.loan_applications, loan_checks, _label)


@query
def check_batch(spark, sf_dir):
    """The row count of every check of a batch; one check fails and is reported as such."""
    data = views.loan_applications(spark, sf_dir)
    batch = {**loan_checks(data), "no_such_column": lambda: pl.untrimmed_values(data, "missing_column")}
    results = pl.run_checks(spark, batch)
    counted = [
        (r.agg(F.count("*").alias("n_rows")) if isinstance(r, DataFrame) else data.agg(F.lit(None).cast("long").alias("n_rows")))
        .select(F.lit(label).alias("label"), "n_rows")
        for label, r in results.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def staging_load(spark, sf_dir):
    """dirty_customer written as CSV, staged from it, and read back unchanged."""
    folder = shared_folder(spark, "staging-load")
    raw = views.dirty_customer(spark, sf_dir)
    pl.write_csv(raw, f"{folder}/raw")
    return pl.load_staging(spark, f"{folder}/raw", path=f"{folder}/staging", schema=raw.schema)


@query
def staging_inferred(spark, sf_dir):
    """The same without a schema: numbers are inferred, all else stays text."""
    folder = shared_folder(spark, "staging-inferred")
    pl.write_csv(views.dirty_customer(spark, sf_dir), f"{folder}/raw")
    return pl.load_staging(spark, f"{folder}/raw", path=f"{folder}/staging")


@query
def row_positions(spark, sf_dir):
    """Every order with its position in the files."""
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return pl.with_row_id(orders, "row_index")


# --- cleaning -------------------------------------------------------------


@query
def clean_dedup(spark, sf_dir):
    return pl.keep_first(views.dirty_customer(spark, sf_dir), CUSTOMER_KEY, "row_id")


@query
def clean_dedup_orders(spark, sf_dir):
    """The first order of every customer."""
    return pl.keep_first(views.table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")


@query
def clean_standardize(spark, sf_dir):
    spec = pl.CleanSpec(trim=("c_name",), sentence=("c_mktsegment",))
    return pl.standardize(views.dirty_customer(spark, sf_dir), spec)


@query
def clean_trim(spark, sf_dir):
    return pl.standardize(views.dirty_part(spark, sf_dir), pl.CleanSpec(trim=("p_type",)))


@query
def clean_flag(spark, sf_dir):
    spec = pl.CleanSpec(flag_ranges=CUSTOMER_RANGES)
    return pl.standardize(views.dirty_customer(spark, sf_dir), spec)


@query
def cleaned_table(spark, sf_dir):
    return pl.clean(views.dirty_customer(spark, sf_dir), CUSTOMER_CLEANING, "row_id")


@query
def loan_cleaned_table(spark, sf_dir):
    spec = pl.CleanSpec(
        key=LOAN_CLEANING.key,
        trim=LOAN_CLEANING.trim,
        sentence=LOAN_CLEANING.sentence,
        flag_ranges=LOAN_CLEANING.flag_ranges,
        drop=(*LOAN_CLEANING.drop, "row_id"),
    )
    return pl.clean(views.loan_applications(spark, sf_dir), spec, "row_id")


# --- loan applications with the default rules -------------------------------


@query
def loan_scorecard(spark, sf_dir):
    return pl.scorecard(views.loan_applications(spark, sf_dir), LOAN_KEY, LOAN_RULES, "row_id")


@query
def loan_summary(spark, sf_dir):
    return pl.summary(views.loan_applications(spark, sf_dir), LOAN_KEY, LOAN_RULES, "row_id")


@query
def loan_issues_log(spark, sf_dir):
    return pl.issues_log(views.loan_applications(spark, sf_dir), "row_id", LOAN_KEY, LOAN_RULES)


# --- reports --------------------------------------------------------------


@query
def health_bars(spark, sf_dir):
    return pl.health_bars(_customer_card(spark, sf_dir))


@query
def dimension_breakdown(spark, sf_dir):
    return pl.dimension_breakdown(_customer_card(spark, sf_dir))


@query
def issue_drilldown(spark, sf_dir):
    return pl.issue_drilldown(_customer_card(spark, sf_dir), _customer_issues(spark, sf_dir), "c_acctbal")


@query
def issue_drilldown_all(spark, sf_dir):
    return pl.issue_drilldown(_customer_card(spark, sf_dir), _customer_issues(spark, sf_dir))


@query
def issue_type_counts(spark, sf_dir):
    return pl.issue_type_counts(_customer_issues(spark, sf_dir))


@query
def report_files(spark, sf_dir):
    """The scorecard as a dashboard reads it back from the written report."""
    folder = shared_folder(spark, "report-files")
    data = views.dirty_customer(spark, sf_dir)
    done = pl.Inspection(data, CUSTOMER_KEY, views.CUSTOMER_RULES, "row_id").run()
    return pl.read_csv(spark, done.write(folder)["scorecard"])


@query
def table_shape(spark, sf_dir):
    return pl.shape(views.loan_applications(spark, sf_dir).select(LOAN_SCHEMA.fieldNames()))


@query
def table_preview(spark, sf_dir):
    return pl.preview(views.loan_applications(spark, sf_dir), "row_id")


# --- quality over time ------------------------------------------------------


def _daily_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.dirty_events(spark, sf_dir)
    return pl.overall_score(events, "event_id", views.EVENT_RULES, by=["batch_date"])


def _daily_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.dirty_events(spark, sf_dir)
    return pl.scorecard(events, "event_id", views.EVENT_RULES, by=["batch_date"])


@query
def quality_trend(spark, sf_dir):
    """Daily scores appended to a history, then read from it."""
    folder = shared_folder(spark, "quality-trend")
    pl.append_history(_daily_scores(spark, sf_dir), folder)
    return pl.quality_trend(spark, folder)


@query
def daily_scorecard(spark, sf_dir):
    return _daily_cards(spark, sf_dir)


@query
def score_drift(spark, sf_dir):
    return pl.score_drift(_daily_scores(spark, sf_dir))


@query
def column_drift(spark, sf_dir):
    return pl.score_drift(_daily_cards(spark, sf_dir), "health_score", per="column")


@query
def breaches(spark, sf_dir):
    return pl.breaches(_daily_cards(spark, sf_dir), 97.5).select("batch_date", "column", "health_score", "status")


@query
def date_formats(spark, sf_dir):
    return pl.date_formats(views.loan_applications(spark, sf_dir), ["application_date"])


@query
def stream_scores(spark, sf_dir):
    """The events as a stream: all files waiting make one micro-batch."""
    folder = shared_folder(spark, "stream-scores")
    schema = views.table(spark, sf_dir, "events").schema
    # The glob lets the stream take a single file as well as a folder of files.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    writer = pl.score_stream(
        stream, f"{folder}/history", f"{folder}/checkpoint", "event_id", views.EVENT_RULES
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    return pl.stream_history(spark, f"{folder}/history")


@query
def duplicate_rows_documents(spark, sf_dir):
    """Documents with the same text, language and source."""
    documents = views.table(spark, sf_dir, "documents")
    return pl.duplicate_rows(documents.select("text", "lang", "source"))


# --- further forms ------------------------------------------------------------


@query
def issues_log_first(spark, sf_dir):
    """The log cut to the first 50 rows per column and kind."""
    data = views.dirty_customer(spark, sf_dir)
    return pl.issues_log(data, "row_id", CUSTOMER_KEY, views.CUSTOMER_RULES, cap=50)


@query
def cleaned_table_saved(spark, sf_dir):
    """The cleaned table as a saved table, replaced and scanned."""
    cleaned = pl.clean(views.dirty_customer(spark, sf_dir), CUSTOMER_CLEANING, "row_id")
    # A name of its own: another session's files may lie in the same warehouse.
    return pl.replace_table(cleaned, f"plumbline_cleaned_{uuid.uuid4().hex}")


@query
def staging_documents(spark, sf_dir):
    """Whole documents, line breaks and quotes included, through CSV and back."""
    folder = shared_folder(spark, "staging-documents")
    raw = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    pl.write_csv(raw, f"{folder}/raw")
    return pl.load_staging(spark, f"{folder}/raw", path=f"{folder}/staging", schema=raw.schema, multiline=True)


@query
def report_summary(spark, sf_dir):
    """The summary as a dashboard reads it back from the written report."""
    folder = shared_folder(spark, "report-summary")
    data = views.dirty_customer(spark, sf_dir)
    done = pl.Inspection(data, CUSTOMER_KEY, views.CUSTOMER_RULES, "row_id").run()
    return spark.read.schema(done.summary().schema).json(done.write(folder)["summary"])


@query
def validity_text_numbers(spark, sf_dir):
    """Ranges on numbers in text and on NaN, an allow-list on a number."""
    return pl.validity(views.text_numbers(spark, sf_dir), views.TEXT_NUMBER_RULES)


@query
def padded_values_unicode(spark, sf_dir):
    """Tabs and no-break spaces around values."""
    return pl.padded_values(views.text_numbers(spark, sf_dir), ["code"])


@query
def completeness_in_memory(spark, sf_dir):
    """A frame made from rows that a program holds: a figure per nation, from all customers."""
    customers = views.dirty_customer(spark, sf_dir)
    figures = customers.groupBy("c_nationkey").agg(
        F.min("c_acctbal").alias("least"), F.max(F.when(F.col("c_acctbal") > 9990, F.col("c_name"))).alias("richest")
    )
    return pl.completeness(spark.createDataFrame(figures.collect(), figures.schema))


@query
def date_formats_odd(spark, sf_dir):
    return pl.date_formats(views.date_texts(spark, sf_dir), ["written"])


@query
def trend_by_label(spark, sf_dir):
    """A history whose labels are text: leading zeros, the empty label and none survive."""
    folder = shared_folder(spark, "trend-by-label")
    orders = views.table(spark, sf_dir, "orders")
    priority = "substr(o_orderpriority, 1, 1)"
    for label in (f"lpad({priority}, 3, '0')", priority, "if(o_orderstatus = 'P', NULL, '')"):
        scores = orders.selectExpr(f"{label} AS label").groupBy("label")
        pl.append_history(scores.agg(F.count("*").cast("double").alias("overall_health_score")), folder, "label")
    return pl.quality_trend(spark, folder, "label")


# --- profiles that merge ----------------------------------------------------------


def _profiled_days(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A store with a profile of every day of the events; the even days were profiled again."""
    folder = shared_folder(spark, name)
    events = views.dirty_events(spark, sf_dir)
    pl.append_profile(events, folder, "batch_date", "event_id", views.EVENT_RULES)
    pl.append_profile(events.where("day(batch_date) % 2 = 0"), folder, "batch_date", "event_id", views.EVENT_RULES)
    return folder


@query
def merged_scorecard(spark, sf_dir):
    """All days scored as one table, from their profiles."""
    return pl.merged_scorecard(spark, _profiled_days(spark, sf_dir, "merged-scorecard"))


@query
def merged_summary(spark, sf_dir):
    """The same after the days were merged into one batch."""
    folder = _profiled_days(spark, sf_dir, "merged-summary")
    pl.merge_batches(spark, folder, f"{folder}-whole", "1992-01-01")
    return pl.merged_summary(spark, f"{folder}-whole")


@query
def daily_scorecard_total(spark, sf_dir):
    """Every day and all days together, from one pass."""
    events = views.dirty_events(spark, sf_dir)
    return pl.scorecard_with_total(events, "event_id", views.EVENT_RULES, by=["batch_date"])


@query
def approximate_keys(spark, sf_dir):
    """Sketches of every day's keys, kept in a history and merged; whether the estimates hold what they promise."""
    folder = shared_folder(spark, "approximate-keys")
    events = views.dirty_events(spark, sf_dir)
    columns = ["event_id", "user_id", "value"]
    pl.append_history(pl.key_sketches(events, columns, ["batch_date"]), folder)
    guess = pl.approximate_uniqueness(pl.read_history(spark, folder))
    exact = reduce(DataFrame.unionByName, [pl.key_uniqueness(events, c) for c in columns])
    held = F.abs(F.col("approx_duplicate_key_count") - F.col("duplicate_key_count")) <= F.col("margin")
    return guess.join(exact, "column").select(
        "column", "total_rows", "duplicate_key_count", "uniqueness_score", held.alias("within_margin")
    )


@query
def completeness_files(spark, sf_dir):
    """Missing cells of the order lines, counted from the footers of their files where those tell."""
    return pl.completeness_of_files(spark, f"{sf_dir}/lineitem.parquet")


def _event_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The dirty events as a stream of several micro-batches: four files, one at a time."""
    rows = views.dirty_events(spark, sf_dir)
    rows.repartition(4, "event_type").write.parquet(f"{folder}/files")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/files")


@query
def stream_repeats(spark, sf_dir):
    """Keys that return in later micro-batches count as duplicates: the stream's state remembers them."""
    folder = shared_folder(spark, "stream-repeats")
    stream = _event_stream(spark, sf_dir, folder).select("user_id", "value")
    writer = pl.score_stream(
        stream, f"{folder}/history", f"{folder}/checkpoint", "user_id", views.EVENT_RULES, seen_within="365 days"
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    return pl.stream_scorecard(spark, f"{folder}/history")


@query
def stream_profiles(spark, sf_dir):
    """A stream profiled by micro-batch and scored as one table, casings across micro-batches included."""
    folder = shared_folder(spark, "stream-profiles")
    stream = _event_stream(spark, sf_dir, folder).drop("batch_date")
    writer = pl.profile_stream(stream, f"{folder}/store", f"{folder}/checkpoint", "event_id", views.EVENT_RULES)
    writer.trigger(availableNow=True).start().awaitTermination()
    return pl.merged_scorecard(spark, f"{folder}/store", "batch_id")


@query
def new_breaches(spark, sf_dir):
    """Columns that fall below the threshold on a day, having been above it the day before."""
    found = pl.new_breaches(_daily_cards(spark, sf_dir), 97.5)
    return found.select("batch_date", "column", "health_score", "previous_score")


# --- clustered, replaced and batched ------------------------------------------------


def _clustered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders staged in buckets of their customers."""
    orders = views.table(spark, sf_dir, "orders")
    return pl.replace_table(orders, f"plumbline_orders_{uuid.uuid4().hex}", ["o_custkey"], 16)


@query
def clustered_uniqueness(spark, sf_dir):
    return pl.key_uniqueness(_clustered_orders(spark, sf_dir), "o_custkey", clustered=True)


@query
def clustered_dedup(spark, sf_dir):
    return pl.keep_first(_clustered_orders(spark, sf_dir), "o_custkey", "o_orderkey", clustered=True)


@query
def clustered_issues(spark, sf_dir):
    return pl.issues_duplicate_key(_clustered_orders(spark, sf_dir), "o_orderkey", "o_custkey", clustered=True)


@query
def issues_hot_key(spark, sf_dir):
    """One key holds every third order; its rows are dealt over tasks by their count."""
    orders = views.table(spark, sf_dir, "orders")
    hot = orders.selectExpr("o_orderkey", "if(o_orderkey % 3 = 0, 1, o_custkey) AS o_custkey")
    return pl.issues_duplicate_key(hot, "o_orderkey", "o_custkey", rows_per_task=1000)


@query
def cleaned_table_replaced(spark, sf_dir):
    """A saved table replaced by what was cleaned from itself."""
    name = f"plumbline_self_{uuid.uuid4().hex}"
    raw = pl.replace_table(views.dirty_customer(spark, sf_dir), name)
    return pl.replace_table(pl.clean(raw, CUSTOMER_CLEANING, "row_id"), name)


@query
def check_batch_shared(spark, sf_dir):
    """The same batch as `check_batch`, with one pass for each different grouping."""
    data = views.loan_applications(spark, sf_dir).drop("row_id")
    batch = {**loan_batch(), "no_such_column": pl.Untrimmed("missing_column")}
    results = pl.run_batch(data, batch, shared_folder(spark, "check-batch"))
    counted = [
        (r.agg(F.count("*").alias("n_rows")) if isinstance(r, DataFrame) else data.agg(F.lit(None).cast("long").alias("n_rows")))
        .select(F.lit(label).alias("label"), "n_rows")
        for label, r in results.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def batch_snapshot(spark, sf_dir):
    """The snapshot of that batch, which shares its pass with missing counts and duplicate keys."""
    data = views.loan_applications(spark, sf_dir).drop("row_id")
    return pl.run_batch(data, loan_batch(), shared_folder(spark, "batch-snapshot"))["snapshot"]


@query
def staging_quotes(spark, sf_dir):
    """Cells with a quote among their characters, in a file that quotes nothing, and short rows."""
    folder = shared_folder(spark, "staging-quotes")
    parts = views.table(spark, sf_dir, "part").selectExpr(
        "p_partkey", """concat(p_size, '" ', p_type, if(p_size % 7 = 0, ' "', '')) AS size""", "p_brand"
    )
    parts.write.csv(f"{folder}/raw", header=True, quote="")
    return pl.load_staging(spark, f"{folder}/raw", path=f"{folder}/staging", schema=parts.schema)
