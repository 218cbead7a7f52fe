"""Staging: raw data lands as it is, in a columnar table the checks can prune."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from plumbline.functions.values import quoted
from plumbline.sources.csv import read_csv
from plumbline.sources.rows import with_row_id

# Properties of a replaced table: the tables that hold its rows now and held them before.
CURRENT, PREVIOUS = "plumbline.current", "plumbline.previous"


def _table_name(table: str) -> str:
    return ".".join(quoted(part) for part in table.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    """What DESCRIBE says about a table as a whole: its location, buckets and so on."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_table_name(table)}").collect()]
    start = next(i for i, (name, _) in enumerate(rows) if name == "# Detailed Table Information")
    return dict(rows[start + 1 :])


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_table_name(table)}").collect()}


def replace_table(df: DataFrame, table: str, cluster_by: Sequence[str] = (), buckets: int = 0) -> DataFrame:
    """Gives `table` the rows of `df`, or leaves it as it was.

    The rows are written as a table of their own, `<table>_<random>`; only when that has succeeded is `table`, a name
    for the files of such a table, switched to it. So a write that fails changes nothing, `df` may read `table` itself,
    and queries that began before the switch finish on the old files: the version before the new one stays, older
    ones are dropped. If columns and buckets stay the same the switch is one change in the catalog; otherwise the
    name is dropped and made again, between which it is missing for a moment while both versions are kept.

    With `cluster_by` and `buckets` the rows are dealt into buckets by those columns, sorted in each: grouping,
    windows and joins on them then need no shuffle.
    """
    if bool(cluster_by) != (buckets > 0):
        raise ValueError("give both cluster_by and buckets, or neither")
    spark = df.sparkSession
    name, version = _table_name(table), f"{table}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet")
    if cluster_by:
        writer = writer.bucketBy(buckets, *cluster_by).sortBy(*cluster_by)
    try:
        writer.saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(version)}")
        raise
    new = _details(spark, version)
    exists = spark.catalog.tableExists(table)
    old = _details(spark, table) if exists else {}
    before = _properties(spark, table) if exists else {}
    same = CURRENT in before and spark.table(table).schema == spark.table(version).schema
    same = same and all(old.get(k) == new.get(k) for k in ("Num Buckets", "Bucket Columns", "Sort Columns"))
    properties = {CURRENT: version, PREVIOUS: before.get(CURRENT, "")}
    listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(new['Location'])}")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")
    else:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spark.table(version).schema)
        keys = ", ".join(quoted(c) for c in cluster_by)
        layout = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS" if cluster_by else ""
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {layout} LOCATION {_text(new['Location'])}"
            f" TBLPROPERTIES ({listed})"
        )
    spark.catalog.refreshTable(table)
    if before.get(PREVIOUS):
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(before[PREVIOUS])}")
    return spark.table(table)


def replace_parquet(df: DataFrame, path: str) -> DataFrame:
    """Writes the rows over the folder: readers and failures in between see it incomplete; see `replace_table`."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_staging(
    spark: SparkSession,
    csv_path: str,
    table: str | None = None,
    path: str | None = None,
    schema: T.StructType | None = None,
    row_id: str | None = None,
    cluster_by: Sequence[str] = (),
    buckets: int = 0,
    **reading: Any,
) -> DataFrame:
    """Replace a staging table (or Parquet folder) with the rows of a raw CSV.

    `row_id` adds a column of that name with the row's position in the files; `cluster_by` and `buckets` deal
    the rows of a table into buckets by key, see `replace_table`; `reading` are the options of `read_csv`.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    if path is not None and cluster_by:
        raise ValueError("only a table can be clustered")
    rows = read_csv(spark, csv_path, schema, **reading)
    if row_id is not None:
        rows = with_row_id(rows, row_id)
    return replace_table(rows, table, cluster_by, buckets) if table is not None else replace_parquet(rows, path)
