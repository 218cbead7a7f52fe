"""Helpers the operators share: Arrow batches in slices, written stages, text hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python task works on at once.
SLICE_BYTES = 2 << 20
#: Whole texts that Python is given at a time where a step holds several versions of them.
TEXT_ROWS = 1000


def column(name: str) -> Column:
    """A column by its exact name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def slices(batches: Iterable[pa.RecordBatch], name: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about `most` bytes of a column, never less than one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + most, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def packed(rows: DataFrame) -> DataFrame:
    """The rows with the column `text` compressed, as `size` and `packed`, for a cheaper shuffle; null is empty."""
    keys = [c for c in rows.columns if c != "text"]
    schema = rows.drop("text").schema.add("size", "long", False).add("packed", "binary", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 3)
        for batch in slices(batches, "text"):
            texts = [x or b"" for x in batch.column("text").to_pylist()]
            small = pa.array([codec.compress(x, asbytes=True) for x in texts], pa.binary())
            size = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*map(batch.column, keys), size, small], [*keys, "size", "packed"])

    return rows.select(*keys, F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def unpacked(batch: pa.RecordBatch) -> list[bytes]:
    """The texts of compressed rows."""
    codec = pa.Codec("zstd")
    pairs = zip(batch.column("packed").to_pylist(), batch.column("size").to_pylist(), strict=True)
    return [codec.decompress(x, n, asbytes=True) for x, n in pairs]


def restored(rows: DataFrame) -> DataFrame:
    """Compressed rows with their texts again, as the last column; what is no UTF-8 becomes U+FFFD."""
    keys = [c for c in rows.columns if c not in ("size", "packed")]
    schema = rows.select(*keys).schema.add("text", "string", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed"):
            texts = pa.array([str(x, "utf-8", "replace") for x in unpacked(batch)], pa.string())
            yield pa.RecordBatch.from_arrays([*map(batch.column, keys), texts], [*keys, "text"])

    return rows.mapInArrow(run, schema)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share.

    Only where that setting is missing, as in tests, the session's warehouse folder serves.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/plumbline-llm/{name}-{uuid.uuid4().hex}"


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """What runs inside gives Python so many rows at a time; the session's own setting is put back afterwards."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, rows)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
