"""Reading sets of Parquet tables and attaching a manifest as views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..sinks.parquet import table_path


def load_tables(spark: SparkSession, names: Iterable[str], base: str, cache: bool = False) -> dict[str, DataFrame]:
    tables = {name: spark.read.parquet(table_path(base, name)) for name in names}
    if cache:
        tables = {n: df.persist(StorageLevel.MEMORY_AND_DISK) for n, df in tables.items()}
    return tables


def attach_catalog(spark: SparkSession, manifest: Mapping[str, Mapping[str, str]],
                   exclude_groups: Iterable[str] = ()) -> dict[str, dict[str, DataFrame]]:
    """Register every table of a manifest as a temporary view, group by group."""
    skipped = set(exclude_groups)
    attached: dict[str, dict[str, DataFrame]] = {}
    for group, tables in manifest.items():
        if group in skipped:
            continue
        attached[group] = {name: spark.read.parquet(path) for name, path in tables.items()}
        for name, df in attached[group].items():
            df.createOrReplaceTempView(name)
    return attached
