"""Counts that Parquet files hold in their footers, read without the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import scoring
from plumbline.functions.values import FLOAT_TYPES
from plumbline.operators.profile import cell_counts
from plumbline.operators.table import COLUMNS_PER_PASS, Field, Table


def _v2_session(spark: SparkSession) -> SparkSession:
    """A session beside the given one whose Parquet reader answers counts from footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def _pushable(f: Field) -> bool:
    """Whether the footer's count of nulls says how many cells are missing: NaN is missing too, but no null."""
    return not isinstance(f.dtype, (*FLOAT_TYPES, T.ArrayType, T.MapType, T.StructType, T.VariantType))


def footer_counts(spark: SparkSession, path: str) -> list[DataFrame]:
    """One-row frames with the row count and the present cells (by position) of columns that footers can answer for.

    They are plans of a session of their own, in which the aggregate is pushed into the scan of the files.
    """
    t = Table(_v2_session(spark).read.parquet(path))
    fields = [f for f in t.fields if _pushable(f)]
    chunks = [fields[i : i + COLUMNS_PER_PASS] for i in range(0, len(fields), COLUMNS_PER_PASS)] or [[]]
    return [
        t.df.agg(F.count("*").alias("total"), *(F.count(f.ref).alias(f.ref) for f in chunk)) for chunk in chunks
    ]


def completeness_of_files(spark: SparkSession, path: str) -> DataFrame:
    """What `completeness` gives for the Parquet files at `path`, with most counts taken from their footers.

    The counts of columns without NaN are read when this is called, one row that reaches the driver; floating-point
    and nested columns are scanned as usual, those columns alone, when the result is.
    """
    t = Table(spark.read.parquet(path))
    known: dict[str, int] = {}
    for frame in footer_counts(spark, path):
        # A pushed count over no file at all comes back as NULL.
        known |= {name: n or 0 for name, n in frame.first().asDict().items()}
    total = known.pop("total")
    listed = [(f.ordinal, total, total - known[f.ref]) for f in t.fields if f.ref in known]
    parts = [spark.createDataFrame(listed, "ordinal int, total long, missing long")]
    scanned = [f for f in t.fields if f.ref not in known]
    if scanned:
        parts.append(cell_counts(t, scanned).select("ordinal", "total", "missing"))
    return reduce(DataFrame.union, parts).select(
        t.column_name(),
        F.col("missing").alias("missing_count"),
        F.expr(f"{scoring.as_number(scoring.share('missing', 'total'))} AS missing_pct"),
        F.expr(f"{scoring.as_number(scoring.missing_score('missing', 'total'))} AS completeness_score"),
    )
