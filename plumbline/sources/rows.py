"""Row positions for file-backed DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Add the 0-based position of each row, counting through the files by path.

    `df` must read files, with nothing but projections and filters on top; rows
    that a filter drops are not counted.  Rows of one file split sit next to each
    other in one task, so a position is the number of rows in earlier splits plus
    the distance from the split's first row.  The only thing sorted is one row
    per split, and the only thing that moves: 16 bytes per split are broadcast,
    so the table stays where it is.  Splits are at least a row group or a block
    of a file, so that this is bounded by a ten-millionth of the input or so.
    """
    if name in df.columns:
        raise ValueError(f"column {name} already exists")
    split = F.struct(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )
    rows = df.select("*", split.alias("_split"), F.monotonically_increasing_id().alias("_at"))
    splits = rows.groupBy("_split").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = W.orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    offsets = splits.select(F.xxhash64("_split").alias("_key"), shift.alias("_shift"))
    return (
        rows.withColumn("_key", F.xxhash64("_split"))
        .join(F.broadcast(offsets), "_key")
        .withColumn(name, F.col("_at") + F.col("_shift"))
        .drop("_split", "_key", "_at", "_shift")
    )
