"""Parquet tables: materialise and reload, partitioned exports, the run manifest."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach: below the session's checkpoint folder, or
    a local temporary one where the session names none and runs in one process (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not named and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = named.rstrip("/") if named else tempfile.mkdtemp(prefix="carestitch-")
    return f"{base}/carestitch-{uuid.uuid4().hex}"


#: Drops an execution's shuffle files when it ends; otherwise they stay until the driver happens to collect its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in this block leave no shuffle files. A frame that is read again must not run in it: its exchanges are gone."""
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def write_and_reload(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None, mode: str = "overwrite") -> DataFrame:
    """Write a table and read it back under the same schema; the shuffles that made it are dropped.

    The schema is given to the reader: nothing is inferred from folder names, and a table
    without rows (hence without partition folders) keeps its columns.
    """
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").partitionBy(*columns).parquet(path)
    return _reload(df, path, bool(columns))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch files in any file system Spark can write."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _reload(df: DataFrame, path: str, partitioned: bool) -> DataFrame:
    spark = df.sparkSession
    written = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    if partitioned and written.isEmpty():
        # No partition folder, no file: leave one that tells other readers the columns.
        spark.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path)
    return written


def export_tables(tables: Mapping[str, DataFrame], base: str,
                  partition_by: Mapping[str, str] | None = None) -> dict[str, str]:
    """Write a set of tables; returns their paths.

    Partitioned tables are rebalanced by the partition column, so small values share
    files and a dominant value is split over many tasks.
    """
    paths = {}
    for name, df in tables.items():
        column = (partition_by or {}).get(name)
        paths[name] = table_path(base, name)
        if column:
            df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(paths[name])
            _reload(df, paths[name], True)
        else:
            df.write.mode("overwrite").parquet(paths[name])
    return paths


def write_by_domain(df: DataFrame | Sequence[DataFrame], path: str) -> DataFrame:
    """Matched facts partitioned by the domain of their standard concept.

    Rebalancing keeps the number of files near the data's size instead of tasks times
    domains, and splits a dominant domain. Of several frames each is written after the one
    before, so that the shuffles of one take disk at a time.
    """
    frames = [df] if isinstance(df, DataFrame) else list(df)
    for i, frame in enumerate(frames):
        balanced = frame.hint("rebalance", "mapped_domain_id")
        back = write_and_reload(balanced, path, "mapped_domain_id", "append" if i else "overwrite")
    return back


def write_by_field(df: DataFrame, path: str) -> DataFrame:
    """Code lookups partitioned by the field they serve."""
    return write_and_reload(df.hint("rebalance", "field"), path, "field")


def write_staged(df: DataFrame, path: str, split_by: str, partial: bool = False) -> DataFrame:
    """A large table built in one job, laid out by a chosen column and by domain.

    The whole table is replaced, so nothing of an earlier run stays. With ``partial`` only
    the partitions present in the frame are: for frames that cover some values of the split
    column within one staging run (row ids hold for one run).
    """
    keys = [split_by, "mapped_domain_id"]
    (
        df.hint("rebalance", *keys).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if partial else "static").partitionBy(*keys).parquet(path)
    )
    return _reload(df, path, not partial)


def distinct_splits(df: DataFrame, column: str) -> DataFrame:
    """The sorted distinct values a staged build is split by."""
    return df.select(F.col(column).alias("column_values_to_split_on")).distinct().orderBy("column_values_to_split_on")


# -- manifest ---------------------------------------------------------------------------

def write_manifest(spark: SparkSession, manifest: Mapping[str, Mapping[str, str]], path: str) -> None:
    """{group: {table: path}} as one JSON file in any file system Spark can write.

    The file is written beside its place and renamed over it: readers see the manifest before or this one, whole.
    """
    text = json.dumps(manifest, sort_keys=True, indent=4)
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    draft = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    try:
        out = fs.create(draft, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        rename = getattr(hadoop, "Options$Rename")
        how = spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, how)
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def read_manifest(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    (row,) = spark.read.text(path, wholetext=True).collect()
    return json.loads(row.value)
