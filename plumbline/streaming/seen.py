"""Which keys of a stream are new, over all its micro-batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.values import key_text, quoted
from plumbline.operators.table import Table

# Marks the rows that announce a new key, among the rows of the stream.
NEW_KEY = "_plumbline_new_key"


def new_keys(
    stream: DataFrame,
    key: str,
    within: str,
    time: str | None = None,
    row_id: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """A row with the `by` columns for each key that the stream has not had for `within`; missing keys are one key.

    Keys are remembered in the state store, by their bounded text form and nothing else, for as long as `within`
    says after they were first seen: by the clock, or by the column `time`. With `time`, rows that are older than
    the newest one by more than that come too late to be judged, and announce nothing; nor do rows without a time.
    """
    t = Table(stream, row_id, by)
    field = t.field(key)
    if field is None:
        raise ValueError(f"no such column: {key}")
    if time is not None and t.field(time) is None:
        raise ValueError(f"no such column: {time}")
    at = F.current_timestamp() if time is None else t.field(time).col.cast("timestamp")
    keys = t.df.select(*t.by_refs, field.comparable("new_keys").alias("key"), at.alias("at")).selectExpr(
        *t.by_refs, f"{key_text('key', field.dtype)} AS key", "at"
    )
    names = [*t.by_refs, "key"]

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each key of an Arrow batch once, as a key may fill most of a batch and its rows go to one task."""
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by(names).aggregate([("at", "max")])
            yield from table.rename_columns([*names, "at"]).select(batch.schema.names).to_batches()

    once = keys.where("at IS NOT NULL").mapInArrow(combined, keys.schema).withWatermark("at", within)
    return t.named(once.dropDuplicatesWithinWatermark(names).select(*t.by_refs))


def with_new_keys(stream: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of a stream, and beside them a row for each new key, told apart by NEW_KEY.

    Both come from one source, so a micro-batch holds its rows and the keys that are new in it.
    """
    empty = [
        F.col(quoted(f.name)) if f.name in found.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in stream.schema.fields
    ]
    return stream.select("*", F.lit(False).alias(NEW_KEY)).union(found.select(*empty, F.lit(True).alias(NEW_KEY)))
