"""The folder every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    Where that is not set, below the session's warehouse, which is shared as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/plumbline/{name}-{uuid.uuid4().hex}"
