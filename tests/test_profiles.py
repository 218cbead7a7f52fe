"""Profiles that merge, sketches, footers, and streams scored as a whole."""

import random

import plumbline as pl
import pytest
from plumbline.operators.partials import counts, merge, profile
from plumbline.operators.profile import column_counts
from plumbline.operators.sketches import margin
from plumbline.plans import profiles
from plumbline.sources.footers import footer_counts

RULES = {"code": {"allowed": ["ab", "cd"]}, "size": {"min": 2, "max": 8}, "tag": {"min": 0, "allowed": ["1", "x"]}}
SCHEMA = "day string, id double, code string, size int, tag string, more array<int>"


def rows_of(seed, n=300):
    rng = random.Random(seed)
    long = "L" * 90
    codes = ["ab", "AB ", "cd", "Cd", None, " x", long, long.lower(), ""]
    ids = [1.0, 2.0, float("nan"), None, -0.0, 0.0, *map(float, range(10, 150))]
    return [
        (
            rng.choice(["a", "b", "", None]),
            rng.choice(ids),
            rng.choice(codes),
            rng.choice([None, 1, 5, 9]),
            rng.choice(["1", "-3", "x", "X", None]),
            rng.choice([None, [1], []]),
        )
        for _ in range(n)
    ]


def same(got, want):
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_counts_of_a_profile_are_those_of_the_table(spark):
    df = spark.createDataFrame(rows_of(1), SCHEMA)
    same(counts(profile(df, "id", RULES, by=["day"])), column_counts(df, "id", RULES, by=["day"]))
    whole = df.drop("day")
    same(counts(merge(profile(df, "id", RULES, by=["day"]))), column_counts(whole, "id", RULES))
    same(counts(profile(whole, None, RULES)), column_counts(whole, None, RULES))
    same(counts(profile(whole.select("size"), "size")), column_counts(whole.select("size"), "size"))
    same(counts(profile(whole, "code")), column_counts(whole, "code"))


def test_a_profile_of_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    same(counts(profile(df.drop("day"), "id", RULES)), column_counts(df.drop("day"), "id", RULES))
    assert counts(profile(df, "id", RULES, by=["day"])).count() == 0


def test_batches_cannot_be_named_like_counts(spark):
    df = spark.createDataFrame([(1, 2)], "key int, x int")
    with pytest.raises(ValueError, match="key"):
        profile(df, by=["key"])
    with pytest.raises(ValueError, match="no such batch"):
        merge(profile(df, by=["x"]), ["key"])


def test_every_batch_and_the_total_from_one_profile(spark):
    df = spark.createDataFrame(rows_of(2), SCHEMA)
    card = pl.scorecard_with_total(df, "id", RULES, by=["day"])
    same(card.where("NOT is_total").drop("is_total"), pl.scorecard(df, "id", RULES, by=["day"]))
    same(card.where("is_total").drop("is_total", "day"), pl.scorecard(df.drop("day"), "id", RULES))
    # A batch without a label is not the total.
    assert card.where("day IS NULL").select("is_total").distinct().count() == 2


def test_a_store_scores_the_union_of_its_batches(spark, tmp_path):
    store = str(tmp_path / "store")
    first, second = (spark.createDataFrame(rows_of(s), SCHEMA) for s in (3, 4))
    first = first.where("day = 'a' OR day = '' OR day IS NULL")
    pl.append_profile(first, store, "day", "id", RULES)
    pl.append_profile(second.where("day = 'b'"), store, "day", "id", RULES)
    whole = first.union(second.where("day = 'b'")).drop("day")
    same(pl.merged_scorecard(spark, store, "day"), pl.scorecard(whole, "id", RULES))
    same(pl.merged_summary(spark, store, "day"), pl.summary(whole, "id", RULES))
    # A batch that is profiled again replaces itself, also if it has no key and no text value any more.
    again = second.where("day = 'b'").limit(7)
    pl.append_profile(again, store, "day", None, RULES)
    keyless = first.drop("day")
    got = {r["column"]: r for r in pl.merged_scorecard(spark, store, "day").collect()}
    want = {r["column"]: r for r in pl.scorecard(keyless.union(again.drop("day")), None, RULES).collect()}
    assert all(got[c]["completeness_score"] == want[c]["completeness_score"] for c in want)
    assert all(got[c]["consistency_score"] == want[c]["consistency_score"] for c in want)
    same(pl.merged_scorecard(spark, store, "day", ["a"]), pl.scorecard(first.where("day = 'a'").drop("day"), "id", RULES))


def test_a_failed_write_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    df = spark.createDataFrame(rows_of(5), SCHEMA)
    pl.append_profile(df, store, "day", "id", RULES)
    before = sorted(map(str, pl.merged_scorecard(spark, store, "day").collect()))
    broken = df.selectExpr("day", "id", "code", "if(id > 100, int(raise_error('no')), size) AS size", "tag", "more")
    with pytest.raises(Exception, match="no"):
        pl.append_profile(broken, store, "day", "id", RULES)
    assert sorted(map(str, pl.merged_scorecard(spark, store, "day").collect())) == before


def test_merged_batches_keep_the_total(spark, tmp_path):
    store, short = str(tmp_path / "store"), str(tmp_path / "short")
    df = spark.createDataFrame(rows_of(6), SCHEMA)
    pl.append_profile(df, store, "day", "id", RULES)
    pl.merge_batches(spark, store, short, "whole", "day")
    pl.append_profile(spark.createDataFrame(rows_of(7), SCHEMA).withColumn("day", pl_lit("next")), short, "day", "id", RULES)
    whole = df.union(spark.createDataFrame(rows_of(7), SCHEMA)).drop("day")
    same(pl.merged_scorecard(spark, short, "day"), pl.scorecard(whole, "id", RULES))
    assert profiles.read_profile(spark, short, "day").cells.select("day").distinct().count() == 2
    with pytest.raises(ValueError, match="no such batch column"):
        profiles.read_profile(spark, short, "week")


def pl_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def test_sketches_hold_their_margin_and_merge(spark):
    df = spark.range(200_000).selectExpr(
        "id % 4 AS part", "id % 90000 AS k", "if(id % 10 = 0, NULL, concat('key ', id % 777)) AS t", "double('NaN') AS f"
    )
    sketches = pl.key_sketches(df, ["k", "t", "f"], ["part"])
    assert sketches.count() == 12
    got = {r["column"]: r for r in pl.approximate_uniqueness(sketches).collect()}
    for column, repeats in (("k", 110_000), ("t", 200_000 - 778), ("f", 199_999)):
        assert got[column]["total_rows"] == 200_000
        assert abs(got[column]["approx_duplicate_key_count"] - repeats) <= got[column]["margin"]
    assert got["k"]["margin"] <= 1.2 * margin() * 90_000 and got["f"]["margin"] == 0
    assert pl.approximate_uniqueness(sketches, ["part"]).count() == 12
    empty = pl.approximate_uniqueness(pl.key_sketches(df.limit(0), ["k"])).first()
    assert (empty["total_rows"], empty["approx_duplicate_key_count"], empty["approx_uniqueness_score"]) == (0, 0, 100.0)
    with pytest.raises(ValueError, match="no such column"):
        pl.key_sketches(df, ["nope"])


def test_footers_answer_for_columns_without_nan(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.createDataFrame(rows_of(8), SCHEMA)
    df.repartition(3).write.parquet(path)
    same(pl.completeness_of_files(spark, path), pl.completeness(spark.read.parquet(path)))
    (counts_,) = footer_counts(spark, path)
    assert counts_.columns == ["total", "c0", "c2", "c3", "c4"]  # neither the double nor the array
    plan = counts_._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(day), COUNT(code), COUNT(size), COUNT(tag)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    only = str(tmp_path / "only")
    spark.createDataFrame([(1.0,), (float("nan"),)], "x double").write.parquet(only)
    same(pl.completeness_of_files(spark, only), pl.completeness(spark.read.parquet(only)))
    df.limit(0).write.parquet(str(tmp_path / "none"))
    same(pl.completeness_of_files(spark, str(tmp_path / "none")), pl.completeness(df.limit(0)))


# --- streams as a whole ---------------------------------------------------------------


def stream_of(spark, tmp_path, batches, schema):
    """One file, and so one micro-batch, for each list of rows."""
    folder = str(tmp_path / "files")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def finish(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


BATCHES = [
    [("k1", "North", 1), ("k2", "North", 2), ("k1", "South", 3), (None, None, 4)],
    [("k3", "North", 5), ("k2", "north", 6), (None, "South", 7)],
    [("k1", "South", 8), ("k1", "South", 9), ("k4" * 50, "South", 10), ("k4" * 50, "South", 11)],
]


def test_keys_that_return_in_later_batches_are_duplicates(spark, tmp_path):
    schema = "id string, region string, n int"
    stream = stream_of(spark, tmp_path, BATCHES, schema)
    history = str(tmp_path / "history")
    writer = pl.score_stream(stream, history, str(tmp_path / "c"), "id", {"n": {"max": 9}}, seen_within="30 days")
    finish(writer)
    whole = spark.createDataFrame([r for b in BATCHES for r in b], schema)
    got = {r["column"]: r for r in pl.stream_scorecard(spark, history).collect()}
    want = {r["column"]: r for r in pl.scorecard(whole, "id", {"n": {"max": 9}}).collect()}
    assert got["id"] == want["id"] and got["n"] == want["n"]
    repeats = pl.stream_history(spark, history, "counts").where("column = 'id'").orderBy("batch_id")
    assert [r["duplicate_keys"] for r in repeats.collect()] == [1, 2, 3]
    assert pl.stream_history(spark, history).count() == 3
    # Without state, each batch knows its own keys alone.
    alone = str(tmp_path / "alone")
    finish(pl.score_stream(stream, alone, str(tmp_path / "c2"), "id"))
    repeats = pl.stream_history(spark, alone, "counts").where("column = 'id'").orderBy("batch_id")
    assert [r["duplicate_keys"] for r in repeats.collect()] == [1, 0, 2]
    with pytest.raises(ValueError, match="needs a key"):
        pl.score_stream(stream, alone, alone, seen_within="1 day")


def test_state_outlives_a_restart(spark, tmp_path):
    schema = "id string, region string, n int"
    history, checkpoint = str(tmp_path / "history"), str(tmp_path / "c")
    for batches in (BATCHES[:1], BATCHES[1:]):  # the query is started again for the later files
        stream = stream_of(spark, tmp_path, batches, schema)
        finish(pl.score_stream(stream, history, checkpoint, "id", seen_within="30 days"))
    repeats = pl.stream_history(spark, history, "counts").where("column = 'id'").orderBy("batch_id")
    assert sorted(r["duplicate_keys"] for r in repeats.collect()) == [1, 2, 3]


def test_old_keys_are_forgotten(spark, tmp_path):
    schema = "id string, at timestamp"
    import datetime as dt

    def day(n):
        return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)

    batches = [[("a", day(0)), ("b", day(0))], [("c", day(9))], [("d", day(10))], [("a", day(10)), ("c", day(11))]]
    stream = stream_of(spark, tmp_path, batches, schema)
    history = str(tmp_path / "history")
    finish(pl.score_stream(stream, history, str(tmp_path / "c"), "id", seen_within="3 days", time="at"))
    repeats = pl.stream_history(spark, history, "counts").where("column = 'id'").orderBy("batch_id")
    assert [r["duplicate_keys"] for r in repeats.collect()] == [0, 0, 0, 1]  # a is new again, c is not


def test_rows_without_a_time_are_not_judged(spark, tmp_path):
    import datetime as dt

    schema = "id string, at timestamp"
    day = dt.datetime(2024, 1, 1)
    stream = stream_of(spark, tmp_path, [[("a", day), ("b", None)], [("a", day), ("b", day)]], schema)
    history = str(tmp_path / "history")
    finish(pl.score_stream(stream, history, str(tmp_path / "c"), "id", seen_within="3 days", time="at"))
    repeats = pl.stream_history(spark, history, "counts").where("column = 'id'").orderBy("batch_id")
    assert [r["duplicate_keys"] for r in repeats.collect()] == [1, 1]


def test_footers_of_partitioned_files(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(50).selectExpr("id", "if(id % 3 = 0, NULL, id) AS x", "id % 4 AS part").write.partitionBy("part").parquet(path)
    same(pl.completeness_of_files(spark, path), pl.completeness(spark.read.parquet(path)))


def test_repeats_are_counted_within_parts(spark, tmp_path):
    schema = "id string, region string, n int"
    stream = stream_of(spark, tmp_path, BATCHES, schema)
    history = str(tmp_path / "history")
    finish(pl.score_stream(stream, history, str(tmp_path / "c"), "id", row_id="n", by=["region"], seen_within="9 days"))
    whole = spark.createDataFrame([r for b in BATCHES for r in b], schema)
    same(pl.stream_scorecard(spark, history, ["region"]), pl.scorecard(whole, "id", row_id="n", by=["region"]))


def test_a_profiled_stream_is_scored_as_one_table(spark, tmp_path):
    schema = "id string, region string, n int"
    stream = stream_of(spark, tmp_path, BATCHES, schema)
    store = str(tmp_path / "store")
    finish(pl.profile_stream(stream, store, str(tmp_path / "c"), "id", {"n": {"max": 9}}))
    whole = spark.createDataFrame([r for b in BATCHES for r in b], schema)
    same(pl.merged_scorecard(spark, store, "batch_id"), pl.scorecard(whole, "id", {"n": {"max": 9}}))


def test_new_breaches_are_told_once(spark):
    rows = [("d1", "x", 90.0), ("d2", "x", 80.0), ("d3", "x", 70.0), ("d4", "x", 95.0), ("d5", "x", 60.0), ("d1", "y", 10.0)]
    history = spark.createDataFrame(rows, "batch_date string, column string, health_score double")
    got = pl.new_breaches(history, 85).select("batch_date", "column", "previous_score").collect()
    assert sorted(map(tuple, got)) == [("d1", "y", None), ("d2", "x", 90.0), ("d5", "x", 95.0)]
    assert pl.new_breaches(history.where("column = 'x'"), 85, per=None).count() == 2
