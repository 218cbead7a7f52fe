"""The input table under positional column names.

Every operator works on columns c0, c1, ... so that dots, spaces, names that
differ only in case, and names that clash with result columns never matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.values import FLOAT_TYPES, is_missing, is_text, key_value, orderable

# Whole-stage codegen gives up beyond spark.sql.codegen.maxFields (100) fields;
# wide tables are aggregated in groups of columns that stay below it.
COLUMNS_PER_PASS = 40

# The row order column inside a Table.
ROW = "row_index"


@dataclass(frozen=True)
class Field:
    ordinal: int
    name: str
    ref: str
    dtype: T.DataType

    @property
    def col(self) -> Column:
        return F.col(self.ref)

    @property
    def missing(self) -> Column:
        return F.expr(is_missing(self.ref, self.dtype))

    @property
    def key(self) -> Column:
        return F.expr(key_value(self.ref, self.dtype))

    def comparable(self, use: str, clustered: bool = False) -> Column:
        """The key form; a type without an order or equality cannot be a key.

        In a table clustered by the key it is the column as it stands, so that the rows can stay where they are.
        """
        if not orderable(self.dtype):
            raise ValueError(f"{use}: column {self.name} of type {self.dtype.simpleString()} cannot be a key")
        if clustered and isinstance(self.dtype, FLOAT_TYPES):
            raise ValueError(f"{use}: a table cannot be clustered by {self.name}, whose NaN and NULL are one key")
        return self.col if clustered else self.key


class Table:
    """A DataFrame, its profiled fields, and its bookkeeping columns.

    `row_id` (row order) and `by` (batch columns) are not profiled.  Field i is
    column c<i>, so the ordinal can be read off the column's name.
    """

    def __init__(self, df: DataFrame, row_id: str | None = None, by: Sequence[str] = ()):
        self.names = df.columns
        self.by = list(by)
        self.row_id = row_id
        absent = [c for c in [row_id, *by] if c is not None and c not in self.names]
        if absent:
            raise ValueError(f"no such column: {', '.join(absent)}")
        refs, self.fields = [], []
        for source in df.schema.fields:
            if source.name == row_id:
                refs.append(ROW)
            elif source.name in self.by:
                refs.append(f"b{self.by.index(source.name)}")
            else:
                ordinal = len(self.fields)
                self.fields.append(Field(ordinal, source.name, f"c{ordinal}", source.dataType))
                refs.append(f"c{ordinal}")
        if not self.fields:
            raise ValueError("a table without columns to profile")
        self.df = df.toDF(*refs)
        self.by_refs = [f"b{i}" for i in range(len(self.by))]

    def field(self, name: str | None) -> Field | None:
        return next((f for f in self.fields if f.name == name), None)

    @property
    def text_fields(self) -> list[Field]:
        return [f for f in self.fields if is_text(f.dtype)]

    def named(self, df: DataFrame) -> DataFrame:
        """Give `by` columns their own names back."""
        return df.withColumnsRenamed(dict(zip(self.by_refs, self.by))) if self.by else df

    def column_name(self, ordinal: str = "ordinal") -> Column:
        return F.array(*(F.lit(f.name) for f in self.fields))[F.col(ordinal)].alias("column")
