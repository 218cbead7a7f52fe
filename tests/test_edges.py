import pytest
from plumbline import (
    CleanSpec,
    categories_outside,
    clean,
    completeness,
    consistency,
    duplicate_key_values,
    duplicate_row_groups,
    duplicate_rows,
    issue_drilldown,
    issues_duplicate_key,
    issues_log,
    keep_first,
    key_uniqueness,
    missing_counts,
    run_checks,
    scorecard,
    standardize,
    summary,
    untrimmed_values,
    validity,
)
from pyspark.sql import functions as F

NAN = float("nan")


def rows(df):
    return [tuple(r) for r in df.collect()]


def by_column(df):
    return {r.column: r for r in df.collect()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "row_id long, k long, v double, s string")
    rules = {"v": {"min": 0}, "s": {"allowed": ["a"]}}
    card = by_column(scorecard(df, "k", rules, "row_id"))
    assert set(card) == {"k", "v", "s"}
    for r in card.values():
        assert (r.missing_pct, r.invalid_pct, r.health_score, r.status) == (0.0, 0.0, 100.0, "Good")
    assert rows(summary(df, "k", rules, "row_id")) == [(100.0, 0, 3, 0, 0, 3)]
    assert rows(issues_log(df, "row_id", "k", rules)) == []
    assert rows(duplicate_rows(df, "row_id")) == [(0, 0.0)]
    assert rows(key_uniqueness(df, "k")) == [("k", 0, 100.0)]
    assert rows(missing_counts(df, ["v"])) == [(None, 0)]
    assert rows(keep_first(df, "k", "row_id")) == []


def test_no_columns(spark):
    with pytest.raises(ValueError):
        scorecard(spark.range(3).withColumnRenamed("id", "row_id"), row_id="row_id")


def test_all_null_text(spark):
    df = spark.createDataFrame([(None,), (None,)], "s string")
    r = scorecard(df).first()
    assert (r.completeness_score, r.consistency_score, r.health_score, r.status) == (0.0, 100.0, 65.0, "Critical")
    assert rows(consistency(df)) == []


def test_nan_is_missing(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 5.0), (1, NAN, NAN), (2, None, None), (3, 2.0, 1e9), (4, 3.0, float("inf"))],
        "row_id long, k double, v double",
    )
    rules = {"v": {"min": 0, "max": 900}}
    assert {r.column: r.missing_count for r in completeness(df, "row_id").collect()} == {"k": 2, "v": 2}
    assert rows(validity(df, rules, "row_id")) == [("v", 2, 40.0, 60.0)]
    assert rows(key_uniqueness(df, "k", "row_id")) == [("k", 1, 80.0)]
    assert rows(issues_log(df, "row_id", "k", rules, cap=50)) == [
        (1, "k", "missing_value"),
        (2, "k", "missing_value"),
        (1, "v", "missing_value"),
        (2, "v", "missing_value"),
        (1, "k", "duplicate_key"),
        (2, "k", "duplicate_key"),
        (3, "v", "invalid_value"),
        (4, "v", "invalid_value"),
    ]
    assert rows(duplicate_rows(df, "row_id")) == [(1, 20.0)]
    for limit in (0, 100):
        assert sorted(r.row_id for r in keep_first(df, "k", "row_id").collect()) == [0, 1, 3, 4]


def test_no_key_or_unknown_key(spark):
    df = spark.createDataFrame([(0, 1), (1, 1)], "row_id long, k long")
    for key in (None, "nope"):
        assert scorecard(df, key, row_id="row_id").first().uniqueness_score == 100.0
        assert rows(issues_log(df, "row_id", key)) == []


def test_rule_on_absent_column(spark):
    df = spark.createDataFrame([(0, 1)], "row_id long, k long")
    rules = {"nope": {"min": 0}, "K": {"min": 5}}
    assert scorecard(df, rules=rules, row_id="row_id").first().health_score == 100.0
    assert rows(validity(df, rules, "row_id")) == []
    assert rows(issues_log(df, "row_id", rules=rules)) == []


def test_range_on_text(spark):
    values = ["abc", " 12 ", "\t5\xa0", "1e5", "1.0d", "0x1A", "0x1p3", "1,000", "", None, "-3", "inf", "nan", ".5"]
    df = spark.createDataFrame(list(enumerate(values)), "row_id long, s string")
    bad = [r[0] for r in rows(issues_log(df, "row_id", rules={"s": {"min": 0, "max": 10}})) if r[2] == "invalid_value"]
    assert bad == [1, 3, 10, 11]


def test_range_on_other_types(spark):
    df = spark.sql(
        "SELECT true AS b, date'2020-01-01' AS d, CAST(5 AS DECIMAL(10, 2)) AS m, array(1) AS a, 7 AS i, 3L AS l"
    )
    rules = {"b": {"max": 0}, "d": {"min": 0}, "m": {"max": 4.5}, "a": {"min": 3}, "i": {"max": 6.5}, "l": {"max": 3}}
    assert {r.column: r.invalid_count for r in validity(df, rules).collect()} == {
        "b": 1,
        "d": 0,
        "m": 1,
        "a": 0,
        "i": 1,
        "l": 0,
    }


def test_allow_list(spark):
    values = ["A", " a ", "\xa0a\t", "b", "", None, "C"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "s string, n int")
    rules = {"s": {"allowed": ["a ", "c"]}, "n": {"allowed": [0, 1, "2"]}}
    assert {r.column: r.invalid_count for r in validity(df, rules).collect()} == {"s": 2, "n": 4}
    assert rows(validity(df, {"s": {"allowed": []}}))[0][1] == 6
    both = {"n": {"min": 1, "allowed": [0, 1, 2, 3, 4, 5]}}
    assert rows(validity(df, both))[0][1] == 2


def test_padding_dialects(spark):
    values = ["x ", "\ty", "z\xa0", "w", "\u3000v", "", "u\x1f"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert consistency(df).first().formatting_issue_count == 5
    assert rows(untrimmed_values(df, "s")) == [("x ",)]
    assert sorted(rows(categories_outside(df, "s", ["X", "w"]))) == sorted(
        [("\ty",), ("z\xa0",), ("\u3000v",), ("",), ("u\x1f",)]
    )


def test_case_variants_mark_the_whole_group(spark):
    df = spark.createDataFrame([(v,) for v in ["Male", "male", "MALE ", "Male", "F", "F", None]], "s string")
    assert consistency(df).first().formatting_issue_count == 4
    long = "Lorem ipsum " * 50
    df = spark.createDataFrame([(long,), (long.upper(),), (long.strip() + "x",), ("É",), ("é",)], "s string")
    assert consistency(df).first().formatting_issue_count == 4


def test_long_text_keys(spark):
    text = "a" * 1000
    df = spark.createDataFrame(
        [(0, text), (1, text + "b"), (2, text), (3, "a" * 64), (4, "a" * 64)], "row_id long, k string"
    )
    assert rows(key_uniqueness(df, "k", "row_id")) == [("k", 2, 60.0)]
    assert sorted(r[0] for r in rows(issues_log(df, "row_id", "k"))) == [0, 2, 3, 4]
    kept = keep_first(df, "k", "row_id").collect()
    assert sorted((r.row_id, r.k) for r in kept) == [(0, text), (1, text + "b"), (3, "a" * 64)]


def test_cap(spark):
    df = spark.range(0, 5000, 1, 16).selectExpr(
        "4999 - id AS row_id", "if(id % 3 = 0, NULL, id % 7) AS k", "if(id % 2 = 0, NULL, -1L) AS v", "'x' AS s"
    )
    log = rows(issues_log(df, "row_id", "k", {"v": {"min": 0}}, cap=50))
    data = {r.row_id: r for r in df.collect()}
    order = sorted(data)
    expected = (
        [(i, "k", "missing_value") for i in order if data[i].k is None][:50]
        + [(i, "v", "missing_value") for i in order if data[i].v is None][:50]
        + [(i, "k", "duplicate_key") for i in order][:50]
        + [(i, "v", "invalid_value") for i in order if data[i].v is not None][:50]
    )
    assert log == expected
    assert len(rows(issues_log(df, "row_id", "k", {"v": {"min": 0}}, cap=3))) == 12


def test_hot_key(spark):
    """A third of all rows share one key; the first rows of late keys are not lost to it."""
    df = spark.range(0, 30000, 1, 12).selectExpr("id AS row_id", "if(id % 3 = 0, -1L, id div 4) AS k", "id AS v")
    data = [(r.row_id, r.k) for r in df.collect()]
    seen, first = {}, set()
    for i, k in sorted(data):
        seen[k] = seen.get(k, 0) + 1
        if seen[k] == 1:
            first.add(i)
    assert rows(key_uniqueness(df, "k", "row_id"))[0][1] == len(data) - len(seen)
    assert {r.row_id for r in keep_first(df, "k", "row_id").collect()} == first
    repeated = [i for i, k in sorted(data) if seen[k] > 1]
    log = [r[0] for r in rows(issues_log(df, "row_id", "k", cap=50)) if r[2] == "duplicate_key"]
    assert log == repeated[:50]
    assert sorted(r[0] for r in rows(issues_duplicate_key(df, "row_id", "k"))) == repeated
    absent = df.selectExpr("row_id", "nullif(k, -1L) AS k")
    assert sorted(r[0] for r in rows(issues_duplicate_key(absent, "row_id", "k"))) == repeated


def test_one_row_of_every_key(spark):
    """Ties and missing row ids leave exactly one row per key."""
    df = spark.createDataFrame(
        [(None, 1, "a"), (None, 1, "b"), (5, 2, "c"), (5, 2, "d"), (7, None, "e"), (None, None, "f"), (1, 3, "g")],
        "row_id long, k int, v string",
    )
    kept = rows(keep_first(df, "k", "row_id"))
    assert sorted(k for _, k, _ in kept if k is not None) == [1, 2, 3]
    assert [v for _, k, v in kept if k is None] == ["e"]
    again = rows(keep_first(df.repartition(5), "k", "row_id"))
    assert sorted(v for *_, v in again) == sorted(v for *_, v in kept)


def test_unknown_columns_are_refused(spark):
    df = spark.createDataFrame([("x ", 500, 0)], "s string, n int, is_flagged_invalid int")
    for spec in (CleanSpec(trim=["S"]), CleanSpec(sentence=["t"]), CleanSpec(drop=["u"]), CleanSpec(flag_ranges={"N": {}})):
        with pytest.raises(ValueError):
            standardize(df, spec)
    with pytest.raises(ValueError):
        standardize(df, CleanSpec(flag_ranges={"n": {"max": 10}}))
    cased = spark.createDataFrame([(" x", "y ")], "a string, b string").toDF("A", "a")
    assert rows(standardize(cased, CleanSpec(trim=["A"]))) == [("x", "y ")]


def test_map_keys_are_refused(spark):
    df = spark.sql("SELECT 1L AS row_id, map('a', 1) AS m")
    for run in (lambda: issues_duplicate_key(df, "row_id", "m"), lambda: keep_first(df, "m", "row_id")):
        with pytest.raises(ValueError):
            run()


def test_key_called_like_a_result(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "occurrence_count int")
    got = duplicate_key_values(df, "occurrence_count").collect()
    assert [tuple(r) for r in got] == [(1, 2)]
    ticked = df.toDF("a`b")
    assert [tuple(r) for r in duplicate_key_values(ticked, "a`b").collect()] == [(1, 2)]


def test_drilldown_of_batches(spark):
    df = spark.createDataFrame([(0, "x", None), (1, "y", 1)], "row_id long, day string, v int")
    card = scorecard(df, rules={}, row_id="row_id", by=["day"])
    log = issues_log(df.drop("day"), "row_id").join(df.select(F.col("row_id").alias("row_index"), "day"), "row_index")
    with pytest.raises(ValueError):
        issue_drilldown(card, log)
    assert rows(issue_drilldown(card, log, by=["day"]))[0][:3] == ("x", 0, "v")


def test_odd_column_names(spark):
    df = spark.createDataFrame(
        [(0, 1, "A", None, 5), (1, 1, "a", 2.0, 50), (2, 2, " b", 3.0, 7)],
        "`row id` long, `a.key` long, `column` string, `status` double, `it's` int",
    )
    rules = {"it's": {"max": 10}, "column": {"allowed": ["a"]}}
    card = by_column(scorecard(df, "a.key", rules, "row id"))
    assert card["a.key"].uniqueness_score == 66.67
    assert card["column"].consistency_score == 0.0
    assert card["column"].validity_score == 66.67
    assert card["status"].missing_pct == 33.33
    assert card["it's"].invalid_pct == 33.33
    assert rows(issues_log(df, "row id", "a.key", rules, cap=50)) == [
        (0, "status", "missing_value"),
        (0, "a.key", "duplicate_key"),
        (1, "a.key", "duplicate_key"),
        (1, "it's", "invalid_value"),
    ]
    spec = CleanSpec(key="a.key", trim=["column"], flag_ranges={"it's": {"max": 10}}, drop=["row id"])
    cleaned = clean(df, spec, "row id")
    assert cleaned.columns == ["a.key", "column", "status", "it's", "is_flagged_invalid"]
    assert sorted(rows(cleaned), key=str) == [(1, "A", None, 5, 0), (2, "b", 3.0, 7, 0)]


def test_nested_and_map_columns(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
           (1, map('a', 1, 'b', 2), array(1, NULL), named_struct('x', 1)),
           (1, map('b', 2, 'a', 1), array(1, NULL), named_struct('x', 1)),
           (1, map('b', 2, 'a', 1), array(1, 2), named_struct('x', 1)),
           (NULL, NULL, NULL, NULL) AS t(i, m, a, s)"""
    )
    assert {r.column: r.missing_count for r in completeness(df).collect()} == {"i": 1, "m": 1, "a": 1, "s": 1}
    assert rows(duplicate_rows(df)) == [(1, 25.0)]
    assert [r.dup_count for r in duplicate_row_groups(df).collect()] == [2]
    only_map = df.select("m")
    assert rows(duplicate_rows(only_map)) == [(2, 50.0)]


def test_nulls_in_different_columns_are_not_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, 1), (0, None)], "a int, b int")
    assert rows(duplicate_rows(df)) == [(1, 25.0)]
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (NAN,), (None,)], "v double")
    assert rows(duplicate_rows(zeros)) == [(2, 50.0)]


def test_wide_table(spark):
    n = 130
    df = spark.range(100).select(
        F.col("id").alias("row_id"),
        *(F.when(F.col("id") % (i + 2) != 0, F.col("id")).alias(f"n{i}") for i in range(n)),
        *(F.concat(F.lit("v"), (F.col("id") % 3).cast("string")).alias(f"s{i}") for i in range(5)),
    )
    rules = {f"n{i}": {"max": 89} for i in range(n)}
    card = by_column(scorecard(df, "n5", rules, "row_id"))
    assert len(card) == n + 5
    for i in range(n):
        gone = sum(v % (i + 2) == 0 for v in range(100))
        assert card[f"n{i}"].missing_pct == float(gone)
        assert card[f"n{i}"].invalid_pct == float(sum(v % (i + 2) != 0 for v in range(90, 100)))
    log = rows(issues_log(df, "row_id", "n5", rules, cap=50))
    missing = [r for r in log if r[2] == "missing_value"]
    assert len(missing) == sum(min(50, sum(v % (i + 2) == 0 for v in range(100))) for i in range(n))


def test_sentence_case(spark):
    df = spark.createDataFrame([(" self-EMPLOYED ",), ("x",), ("",), (None,), ("two WORDS",)], "s string")
    assert rows(standardize(df, CleanSpec(sentence=["s"]))) == [
        ("Self-employed",),
        ("X",),
        ("",),
        (None,),
        ("Two words",),
    ]


def test_check_batch_survives_failures(spark, tmp_path):
    df = spark.createDataFrame([("a ",), ("b",)], "s string")
    checks = {
        "good": lambda: untrimmed_values(df, "s"),
        "no_column": lambda: untrimmed_values(df, "nope"),
        "bad_sql": lambda: spark.sql("SELECT nope FROM nowhere"),
        "late": lambda: df.select(F.col("s").cast("int").alias("n")),
    }
    lazy = run_checks(spark, checks)
    assert set(lazy) == {"good", "no_column_error", "bad_sql_error", "late"}
    written = run_checks(spark, checks, str(tmp_path))
    assert set(written) == {"good", "no_column_error", "bad_sql_error", "late_error"}
    assert rows(written["good"]) == [("a ",)]
