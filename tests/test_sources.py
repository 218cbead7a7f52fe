import pytest
from plumbline import (
    append_history,
    breaches,
    inspect_csv,
    load_staging,
    quality_trend,
    read_csv,
    replace_table,
    score_drift,
    score_stream,
    stream_history,
    summary,
    with_row_id,
    write_csv,
)
from plumbline.plans.loans import KEY, LOAN_CLEANING, LOAN_RULES, LOAN_SCHEMA, loan_checks
from plumbline.sources.shared import shared_folder
from pyspark.errors import PySparkException
from pyspark.sql import functions as F


def rows(df):
    return [tuple(r) for r in df.collect()]


def types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema}


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "i,f,b,bm,s,d,e,big,mix,q\n"
        '1,1.5,True,true,a,2023-01-01,,1,1,"x, ""y"""\n'
        "2,NA,false,,b ,2023-01-02,NA,99999999999999999999,abc, pad\n"
        " 3,1e3,FALSE,false,null,02/01/2023,nan,3,2,N/A\n"
    )
    df = read_csv(spark, str(path))
    assert types(df) == {
        "i": "bigint",
        "f": "double",
        "b": "boolean",
        "bm": "string",
        "s": "string",
        "d": "string",
        "e": "double",
        "big": "string",
        "mix": "string",
        "q": "string",
    }
    assert rows(df) == [
        (1, 1.5, True, "true", "a", "2023-01-01", None, "1", "1", 'x, "y"'),
        (2, None, False, None, "b ", "2023-01-02", None, "99999999999999999999", "abc", " pad"),
        (3, 1000.0, False, "false", None, "02/01/2023", None, "3", "2", None),
    ]


def test_explicit_schema(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("a,b\n1,x\nbad,y\n")
    schema = "a bigint, b string"
    parsed = spark.createDataFrame([], schema).schema
    assert rows(read_csv(spark, str(path), parsed, bad_cells="null")) == [(1, "x"), (None, "y")]
    with pytest.raises(PySparkException):
        read_csv(spark, str(path), parsed).collect()
    with pytest.raises(ValueError):
        read_csv(spark, str(path), spark.createDataFrame([], "b string, a bigint").schema)
    with pytest.raises(ValueError):
        read_csv(spark, str(path), parsed, bad_cells="drop")


def test_surplus_cells_and_line_breaks(spark, tmp_path):
    (tmp_path / "surplus.csv").write_text("a,b\n1,x\n2,y,EXTRA\n3\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path / "surplus.csv"), spark.createDataFrame([], "a bigint, b string").schema).collect()
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path / "surplus.csv")).select("a").collect()
    kept = read_csv(spark, str(tmp_path / "surplus.csv"), surplus="drop")
    assert sorted(rows(kept)) == [(1, "x"), (2, "y"), (3, None)]
    (tmp_path / "breaks.csv").write_text('a,b\n1,"line1\nline2"\n2,y\n')
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "breaks.csv"))
    staged = load_staging(spark, str(tmp_path / "breaks.csv"), path=str(tmp_path / "st"), multiline=True)
    assert sorted(rows(staged)) == [(1, "line1\nline2"), (2, "y")]
    result = inspect_csv(spark, str(tmp_path / "breaks.csv"), str(tmp_path / "out"), "a", multiline=True)
    assert result["summary"]["total_rows"] == 2


def test_whitespace_and_quotes_survive_a_round_trip(spark, tmp_path):
    values = ["a  ", "  b", "\tc", 'say "hi"', "x,y", None, "back\\slash", "é "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, s string")
    write_csv(df, str(tmp_path / "out"))
    assert sorted(rows(read_csv(spark, str(tmp_path / "out")))) == list(enumerate(values))


def test_row_positions(spark, tmp_path):
    for name, start, stop in (("b", 1000, 4000), ("a", 0, 1000), ("c", 4000, 4100)):
        lines = ["n,s"] + [f"{i},{'x' * 40}" for i in range(start, stop)]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = with_row_id(read_csv(spark, str(tmp_path)), "row_index")
        assert df.rdd.getNumPartitions() > 1
        assert sorted(rows(df.select("row_index", "n"))) == [(i, i) for i in range(4100)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.range(5000).repartitionByRange(4, "id").write.parquet(str(tmp_path / "p"))
    df = with_row_id(spark.read.parquet(str(tmp_path / "p")))
    assert sorted(rows(df.select("row_id"))) == [(i,) for i in range(5000)]
    with pytest.raises(ValueError):
        with_row_id(df)


def test_staging(spark, loans, tmp_path):
    raw = loans.drop("row_id")
    write_csv(raw.coalesce(1), str(tmp_path / "raw"))
    staged = load_staging(spark, str(tmp_path / "raw"), path=str(tmp_path / "staged"), row_id="row_index")
    assert types(staged) == {**{f.name: f.dataType.simpleString() for f in LOAN_SCHEMA}, "row_index": "bigint"}
    assert sorted(map(str, rows(staged.drop("row_index")))) == sorted(map(str, rows(raw)))
    table = load_staging(spark, str(tmp_path / "raw"), table="staging_loans", schema=LOAN_SCHEMA)
    assert table.count() == 8
    assert replace_table(raw.limit(3), "staging_loans").count() == 3
    spark.sql("DROP TABLE staging_loans")
    with pytest.raises(ValueError):
        load_staging(spark, str(tmp_path / "raw"))


def test_inspect_csv(spark, loans, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_csv(loans.drop("row_id").coalesce(1), raw)
    result = inspect_csv(spark, raw, out, KEY, LOAN_RULES, LOAN_CLEANING, loan_checks)
    assert result["summary"] == {
        "overall_health_score": 92.71,
        "total_rows": 8,
        "total_columns": 12,
        "columns_critical": 0,
        "columns_warning": 4,
        "columns_good": 8,
    }
    assert result["cleaned_rows"] == 6
    assert set(result["checks"]) == set(loan_checks(loans))
    card = spark.read.csv(result["reports"]["scorecard"], header=True, inferSchema=True)
    assert card.count() == 12 and card.columns[0] == "column"
    assert spark.read.csv(result["reports"]["issues"], header=True).count() == 16
    assert spark.read.json(result["reports"]["summary"]).first().overall_health_score == 92.71
    cleaned = read_csv(spark, result["cleaned"])
    assert cleaned.columns == [c for c in LOAN_SCHEMA.fieldNames() if c != "gender"] + ["is_flagged_invalid"]
    again = inspect_csv(spark, raw, out, "no_such_key")
    assert set(again) == {"summary", "reports"}
    assert again["summary"]["total_rows"] == 8


def test_history(spark, tmp_path):
    path = str(tmp_path / "history")

    def batch(day, score):
        return spark.sql(f"SELECT DATE'{day}' AS batch_date, {score}D AS overall_health_score")

    append_history(batch("2024-01-02", 91.5), path)
    append_history(batch("2024-01-01", 98.48), path)
    append_history(batch("2024-01-03", 70.0), path)
    append_history(batch("2024-01-02", 92.25), path)  # re-run of a batch
    trend = [(str(d), s) for d, s in rows(quality_trend(spark, path))]
    assert trend == [("2024-01-01", 98.48), ("2024-01-02", 92.25), ("2024-01-03", 70.0)]
    drift = rows(score_drift(quality_trend(spark, path)).orderBy("batch_date"))
    assert [r[1:] for r in drift] == [(98.48, None, None), (92.25, 98.48, -6.23), (70.0, 92.25, -22.25)]
    low = rows(breaches(quality_trend(spark, path), 90.0, "overall_health_score"))
    assert [str(r[0]) for r in low] == ["2024-01-03"]


def test_stream(spark, loans, tmp_path):
    source, history = str(tmp_path / "in"), str(tmp_path / "history")
    schema = loans.drop("row_id").schema

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        writer = score_stream(stream, history, str(tmp_path / "checkpoint"), KEY, LOAN_RULES)
        writer.trigger(availableNow=True).start().awaitTermination()
        return stream_history(spark, history)

    for part in (loans.where("row_id < 4"), loans.where("row_id >= 4")):
        part.drop("row_id").coalesce(1).write.mode("append").parquet(source)
    got = rows(run().orderBy("total_rows", "overall_health_score").drop("batch_id"))
    expected = [
        rows(summary(part.drop("row_id"), KEY, LOAN_RULES))[0]
        for part in (loans.where("row_id < 4"), loans.where("row_id >= 4"))
    ]
    assert sorted(got) == sorted(expected)
    loans.drop("row_id").coalesce(1).write.mode("append").parquet(source)
    after = run()
    assert sorted(r.batch_id for r in after.collect()) == [0, 1, 2]
    assert after.where("batch_id = 2").first().overall_health_score == 92.71
    assert stream_history(spark, history, "scorecard").where("batch_id = 2").count() == 12


def test_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_by_batch_equals_each_batch_alone(spark, loans):
    tagged = loans.withColumn("day", F.col("row_id") % 2)
    together = {r.day: tuple(r)[1:] for r in summary(tagged, KEY, LOAN_RULES, "row_id", by=["day"]).collect()}
    for day in (0, 1):
        alone = summary(tagged.where(F.col("day") == day).drop("day"), KEY, LOAN_RULES, "row_id").first()
        assert together[day] == tuple(alone)
