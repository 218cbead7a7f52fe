"""The physical plans that matter on large tables."""

import re

import plumbline as pl
import pytest
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    (
        spark.range(2000)
        .select(
            F.col("id").alias("row_id"),
            (F.col("id") % 700).alias("k"),
            F.when(F.col("id") % 9 != 0, F.col("id")).alias("n"),
            (F.col("id") * 0.5).alias("v"),
            F.concat(F.lit("s"), F.col("id") % 5).alias("s"),
            F.lit("unused").alias("extra"),
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def scans(text):
    return [set(re.findall(r"(\w+):", found)) for found in re.findall(r"ReadSchema: struct<(.*?)>", text)]


def test_range_filter_reaches_the_reader(table):
    text = plan(pl.out_of_range_rows(table, {"n": {"min": 5, "max": 1500.0}, "v": {"max": 900}}, ["k"]))
    assert "PushedFilters: [Or(Or(LessThan(n,5),GreaterThan(n,1500)),And(GreaterThan(v,900.0)" in text
    assert "Exchange" not in text


def test_issue_scan_skips_clean_row_groups(table):
    text = plan(pl.issues_log(table.select("row_id", "n"), "row_id", rules={"n": {"min": 5}}, cap=50))
    assert "PushedFilters: [Or(IsNull(n),LessThan(n,5))]" in text
    assert text.count("WindowGroupLimit") == 4  # partial and final, per salt and per column


def test_whole_log_has_no_window_and_no_sort(table):
    text = plan(pl.issues_log(table.select("row_id", "n"), "row_id", rules={"n": {"min": 5}}))
    assert "Window" not in text and "Exchange" not in text and "Sort" not in text
    keyed = plan(pl.issues_duplicate_key(table, "row_id", "k"))
    # Only counts of keys are put in order, to find those whose rows are dealt over tasks.
    assert "Window" not in keyed and keyed.count("TakeOrdered") == keyed.count("TakeOrderedAndProject(limit=1000, orderBy=[n#")
    assert all(s <= {"row_id", "k"} for s in scans(keyed))


def test_first_duplicates_read_only_the_key(table):
    text = plan(pl.issues_duplicate_key(table, "row_id", "k", cap=50))
    assert text.count("TakeOrderedAndProject(limit=50") == 2
    assert all(s <= {"row_id", "k"} for s in scans(text))


def test_row_positions_leave_the_table_where_it_is(spark, table):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(pl.with_row_id(table, "at"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_profile_reads_each_column_once(table):
    text = plan(pl.column_counts(table, None, {"s": {"allowed": ["s1"]}, "n": {"min": 1}}, "row_id"))
    read = scans(text)
    assert sorted(map(sorted, read)) == [["extra", "s"], ["k", "n", "v"]]


def test_key_check_reads_only_the_key(table):
    assert scans(plan(pl.key_uniqueness(table, "k"))) == [{"k"}]


def test_first_rows_cut_before_the_shuffle(table):
    text = plan(pl.keep_first(table, "k", "row_id"))
    assert "Join" not in text and text.count("WindowGroupLimit") == 2


def test_duplicate_rows_are_one_pass(table):
    assert len(scans(plan(pl.duplicate_rows(table)))) == 1


def test_snapshot_is_one_pass(table):
    text = plan(pl.health_snapshot(table, "k", {"n": {"min": 1}}, ["v"]))
    assert scans(text) == [{"k", "n", "v"}]


def test_no_python_and_no_cross_join(table):
    frames = [
        pl.scorecard(table, "k", {"n": {"min": 1}}, "row_id"),
        pl.issues_log(table, "row_id", "k", {"n": {"min": 1}}),
        pl.clean(table, pl.CleanSpec(key="k", trim=["s"], flag_ranges={"n": {"min": 1}}), "row_id"),
        pl.duplicate_rows(table),
    ]
    for frame in frames:
        text = plan(frame)
        assert not re.search(r"Python|ArrowEval|CartesianProduct|NestedLoop", text)
