"""Folders for tables that queries write and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share.

    Where that is unset, a local session, as in tests, gets a folder of its own; on a cluster no machine would see another's.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tickloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe from changes of what it was read from."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
