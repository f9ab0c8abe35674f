"""Intermediate tables in the folder that driver and executors share.

A table written here cuts the lineage: what follows is recomputed from files, not from the source, when
an executor is lost. The folder is the one that ``spark.checkpoint.dir`` names. Only where that is unset and
Spark runs in one process (tests) is a folder of this machine taken, and set for the session.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def folder(spark: SparkSession) -> str:
    """A new folder name for one run below the shared one."""
    root = spark.conf.get(SETTING, None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set(SETTING, root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """``df`` written once as Parquet and read back."""
    path = f"{folder(df.sparkSession)}/{name}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark remove shuffle files of earlier steps now: it does so when their plans are collected as garbage,
    which takes two rounds (the first one frees what holds them)."""
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
