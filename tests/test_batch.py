"""Shared passes of check batches, hot keys, clustered and replaced tables, odd CSV cells."""

import plumbline as pl
import pytest
from plumbline.plans.loans import LOAN_SCHEMA, loan_batch, loan_checks
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(got, want):
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


# --- batches ---------------------------------------------------------------------------


def test_a_batch_gives_what_its_checks_give(spark, loans, tmp_path):
    data = loans.select(LOAN_SCHEMA.fieldNames())
    got = pl.run_batch(data, loan_batch(), str(tmp_path))
    for label, check in loan_checks(data).items():
        same(got[label], check())


def test_a_batch_reads_the_table_once_for_each_grouping(spark, loans, tmp_path):
    path = str(tmp_path / "loans")
    loans.select(LOAN_SCHEMA.fieldNames()).write.parquet(path)
    data = spark.read.parquet(path)
    passes = pl.shared_passes(data, loan_batch())
    # by key (with the sums), distinct text values, rows out of range, whole rows
    assert len(passes) == 4
    assert all(plan(p).count("FileScan") == 1 for p in passes.values())
    more = {
        "a": pl.MissingCounts(["age"]),
        "b": pl.MissingCounts(["region"]),
        "c": pl.Untrimmed("region"),
        "d": pl.Untrimmed("gender"),
        "e": pl.CategoriesOutside("gender", ["male"]),
    }
    assert list(pl.shared_passes(data, more)) == ["all", "values"]
    got = pl.run_batch(data, more, str(tmp_path / "out"))
    same(got["a"], pl.missing_counts(data, ["age"]))
    same(got["b"], pl.missing_counts(data, ["region"]))
    same(got["c"], pl.untrimmed_values(data, "region"))
    same(got["e"], pl.categories_outside(data, "gender", ["male"]))


def test_a_whole_run_with_a_batch(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,5\n2,\n1,7\n")
    done = pl.inspect_csv(
        spark, str(tmp_path / "a.csv"), str(tmp_path / "out"), "id", checks={"keys": pl.DuplicateKeys("id"), "no": pl.Untrimmed("y")}
    )
    assert [tuple(r) for r in done["checks"]["keys"].collect()] == [(1, 2)] and "no_error" in done["checks"]


def test_several_keys_and_empty_tables(spark, tmp_path):
    rows = [(1, "a", 1.0), (1, "a", None), (None, "b", float("nan")), (None, "b ", 9.0), (2, None, -1.0)]
    df = spark.createDataFrame(rows, "id int, t string, x double")
    checks = {
        "m": pl.MissingCounts(["x", "t"]),
        "id": pl.DuplicateKeys("id"),
        "x": pl.DuplicateKeys("x"),
        "t": pl.Snapshot("t", {"x": {"min": 0}}, ["x"]),
        "i": pl.Snapshot("id", {"x": {"max": 0}}),
        "r": pl.DuplicateRows(["id", "t"]),
        "all": pl.DuplicateRows(),
        "o": pl.OutOfRange({"x": {"max": 5}}, ["id", "x"]),
        "p": pl.OutOfRange({"x": {"min": 0}}, ["t"]),
    }
    for data in (df, df.limit(0)):
        got = pl.run_batch(data, checks, str(tmp_path / f"out{data.count()}"))
        same(got["m"], pl.missing_counts(data, ["x", "t"]))
        same(got["id"], pl.duplicate_key_values(data, "id"))
        same(got["x"], pl.duplicate_key_values(data, "x"))
        same(got["t"], pl.health_snapshot(data, "t", {"x": {"min": 0}}, ["x"]))
        assert got["i"].first()["incomplete_rows"] == 0
        same(got["r"], pl.duplicate_row_groups(data, ["id", "t"]))
        same(got["all"], pl.duplicate_row_groups(data))
        same(got["o"], pl.out_of_range_rows(data, {"x": {"max": 5}}, ["id", "x"]))
        same(got["p"], pl.out_of_range_rows(data, {"x": {"min": 0}}, ["t"]))


def test_failures_stop_their_own_checks_alone(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", {"k": 1}), (2, "b ", None)], "id int, t string, m map<string,int>")
    broken = df.withColumn("x", F.expr("if(id = 2, int(raise_error('broken cell')), 1)"))
    checks = {
        "gone": pl.DuplicateKeys("nope"),
        "map": pl.DuplicateKeys("m"),
        "x": pl.OutOfRange({"x": {"min": 0}}, ["id"]),
        "t": pl.Untrimmed("t"),
    }
    got = pl.run_batch(broken, checks, str(tmp_path))
    assert got["gone_error"] == "no such column: nope" and "cannot be a key" in got["map_error"]
    assert "broken cell" in got["x_error"]
    assert [r["t"] for r in got["t"].collect()] == ["b "]


# --- hot keys ------------------------------------------------------------------------------


def test_a_hot_key_is_dealt_by_its_count(spark):
    """A key with half of all rows goes to as many tasks as its count asks for; the others stay whole."""
    rows = spark.range(40_000).selectExpr("id AS row", "if(id % 2 = 0, 0, id % 5000 + 1) AS k")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = pl.issues_duplicate_key(rows, "row", "k", rows_per_task=1000)
        where = found.select("row_index", F.spark_partition_id().alias("task")).join(
            rows.withColumnRenamed("row", "row_index"), "row_index"
        )
        tasks = {r["k"]: (r["tasks"], r["n"]) for r in where.groupBy("k").agg(
            F.countDistinct("task").alias("tasks"), F.count("*").alias("n")).collect()}
        widest = where.groupBy("task").count().agg(F.max("count")).first()[0]
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert tasks[0][1] == 20_000 and tasks[0][0] >= 6  # 20 parts over 8 tasks
    assert all(tasks[k][0] == 1 for k in list(tasks) if k != 0)
    assert widest < 15_000
    same(found, pl.issues_duplicate_key(rows, "row", "k"))
    assert "BroadcastHashJoin" in plan(found)


def test_dealt_keys_are_all_found(spark):
    rows = [(i, None if i % 5 == 0 else "k" * (i % 7) * 30) for i in range(400)] + [(None, "k"), (7, "only")]
    df = spark.createDataFrame(rows, "row long, k string")
    want = pl.issues_duplicate_key(df, "row", "k")
    for n in (1, 3, 50):
        same(pl.issues_duplicate_key(df, "row", "k", rows_per_task=n), want)
    assert want.count() == 400


# --- tables ----------------------------------------------------------------------------------


def test_clustered_tables_need_no_exchange_on_the_key(spark):
    rows = [(i, f"key {i % 40}" if i % 9 else None, i % 30) for i in range(200)]
    df = spark.createDataFrame(rows, "row long, name string, number long")
    for key in ("name", "number"):
        table = pl.replace_table(df, f"clustered_{key}", [key], 4)
        uniqueness = pl.key_uniqueness(table, key, clustered=True)
        first = pl.keep_first(table, key, "row", clustered=True)
        issues = pl.issues_duplicate_key(table, "row", key, clustered=True)
        same(uniqueness, pl.key_uniqueness(df, key))
        same(first, pl.keep_first(df, key, "row"))
        same(issues, pl.issues_duplicate_key(df, "row", key))
        assert "Exchange hashpartitioning" not in plan(uniqueness) + plan(first) + plan(issues)
    with pytest.raises(ValueError, match="cannot be clustered"):
        pl.key_uniqueness(df.selectExpr("double(row) AS x"), "x", clustered=True)
    with pytest.raises(ValueError, match="both"):
        pl.replace_table(df, "clustered_bad", ["name"])


def test_clustered_staging_from_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,a\n2,b\n1,c\n")
    table = pl.load_staging(spark, str(tmp_path / "a.csv"), table="staged_by_key", cluster_by=["id"], buckets=2)
    assert pl.key_uniqueness(table, "id", clustered=True).first()["duplicate_key_count"] == 1
    again = pl.load_staging(spark, str(tmp_path / "a.csv"), table="staged_by_key", cluster_by=["id"], buckets=2)
    assert "Exchange hashpartitioning" not in plan(pl.key_uniqueness(again, "id", clustered=True))
    with pytest.raises(ValueError, match="only a table"):
        pl.load_staging(spark, str(tmp_path / "a.csv"), path=str(tmp_path / "o"), cluster_by=["id"], buckets=2)


def names(spark, start):
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(start))


def test_a_failed_replacement_leaves_the_table(spark):
    rows = spark.range(100).selectExpr("id", "concat('it''s ', id) AS `odd ``name`")
    pl.replace_table(rows, "kept_table")
    broken = rows.withColumn("id", F.expr("if(id = 50, bigint(raise_error('no')), id)"))
    with pytest.raises(Exception, match="no"):
        pl.replace_table(broken, "kept_table")
    same(spark.table("kept_table"), rows)
    assert len(names(spark, "kept_table")) == 2  # the name and its only version


def test_a_table_is_replaced_from_itself(spark):
    spark.range(100).selectExpr("id", "id % 7 AS k").write.saveAsTable("own_table")  # an ordinary table at first
    pl.replace_table(spark.table("own_table").where("k < 3"), "own_table")
    assert spark.table("own_table").count() == 44
    running = spark.table("own_table")
    for least in (10, 20, 30):
        pl.replace_table(spark.table("own_table").where(f"id >= {least}"), "own_table")
    assert spark.table("own_table").agg(F.min("id")).first()[0] == 30
    assert len(names(spark, "own_table")) == 3  # the name, its version and the one before
    del running
    # Other columns and buckets are taken over as well.
    wider = pl.replace_table(spark.table("own_table").withColumn("more", F.lit("x")), "own_table", ["k"], 3)
    assert wider.columns == ["id", "k", "more"] and spark.table("own_table").where("more = 'x'").count() == wider.count()


# --- CSV cells ----------------------------------------------------------------------------------


@pytest.mark.parametrize("row", ["1,2,,z", "1,2,", "1,2,3", '1,2,""'])
def test_surplus_cells_fail_whatever_they_hold(spark, tmp_path, row):
    (tmp_path / "a.csv").write_text(f"x,y\n{row}\n5,6\n")
    schema = spark.createDataFrame([], "x long, y long").schema
    df = pl.read_csv(spark, str(tmp_path / "a.csv"), schema)
    for some in (df, df.select("x"), df.select("y")):
        with pytest.raises(Exception, match="(?s)FAILED_READ_FILE|columns"):
            some.collect()
    got = pl.read_csv(spark, str(tmp_path / "a.csv"), schema, surplus="drop").collect()
    assert [tuple(r) for r in got] == [(1, 2), (5, 6)]


def test_quotes_inside_cells_are_characters(spark, tmp_path):
    lines = ['1,5" pipe', '2,a""b', '3,"q ""in"" q, r"', '4,""', '5,"""first"', '6,"last"""', "7", '8," "']
    (tmp_path / "a.csv").write_text("x,y\n" + "\n".join(lines) + "\n")
    got = [r["y"] for r in pl.read_csv(spark, str(tmp_path / "a.csv")).orderBy("x").collect()]
    assert got == ['5" pipe', 'a""b', 'q "in" q, r', None, '"first', 'last"', None, " "]


@pytest.mark.parametrize("cell", ['"open', '"open ""q""', '"""', '5,"o'])
def test_cells_that_do_not_close_ask_for_multiline(spark, tmp_path, cell):
    (tmp_path / "a.csv").write_text(f'x,y,z\n1,{cell}\nclosed",2\n')
    with pytest.raises(ValueError, match="multiline"):
        pl.read_csv(spark, str(tmp_path / "a.csv"))


def test_rows_with_nulls_in_other_places_differ(spark):
    rows = [(1, None), (None, 1), (1, None), (0, 0), (None, None), (None, 0), (0, None)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert pl.duplicate_rows(df).first()["duplicate_rows"] == 1
    texts = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("", None), (None, "")], "a string, b string")
    assert pl.duplicate_rows(texts).first()["duplicate_rows"] == 0
    floats = spark.createDataFrame([(0.0, float("nan")), (-0.0, None)], "a double, b double")
    assert pl.duplicate_rows(floats).first()["duplicate_rows"] == 1
