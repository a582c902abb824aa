"""Places for intermediate tables that several jobs read."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, the folder all executors share.

    Without that setting it lies below the warehouse, which all executors share too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
