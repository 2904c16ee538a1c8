"""Folders for intermediate tables that every executor can reach."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below ``spark.checkpoint.dir``.

    Only a session in local mode may go without that setting; it then gets a folder of its own
    machine, which all its tasks share.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="martloom-")
    return f"{shared.rstrip('/')}/{label}-{uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so that several jobs do not compute it again."""
    folder = scratch_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
