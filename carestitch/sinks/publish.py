"""Publishing a finished run: catalog tables and JDBC targets."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.conform import conform_to_ddl
from ..specs import cdm_specs

Manifest = Mapping[str, Mapping[str, str]]

# Manifest groups in the order they are loaded into a database.
JDBC_GROUPS = ("ohdsi", "concept", "prepared_source")


def _load_ready(df: DataFrame, group: str, table: str, version: str, dialect: str | None) -> DataFrame:
    """Model and vocabulary tables under the load rules of a dialect; others, or without one, as they are."""
    if dialect and group in ("ohdsi", "concept") and table in cdm_specs(version):
        return conform_to_ddl(df, table, version, dialect)
    return df


def publish_tables(spark: SparkSession, manifest: Manifest, database: str, location: str,
                   fmt: str = "delta", version: str = "5.4", dialect: str | None = None) -> list[str]:
    """Every table of a manifest as a managed table of a schema at a location.

    ``fmt`` is any table format the session has; Delta needs its own package. With a
    ``dialect`` the tables follow the load rules of ``conform_to_ddl``.
    """
    named, place = database.replace("`", "``"), location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"create schema if not exists `{named}` location '{place}'")
    published = []
    for group, tables in manifest.items():
        for table, path in tables.items():
            name = f"`{named}`.`{table.replace('`', '``')}`"
            _load_ready(spark.read.parquet(path), group, table, version, dialect).write.format(fmt).mode("overwrite").saveAsTable(name)
            published.append(name)
    return published


@dataclass(frozen=True)
class JdbcTarget:
    group: str
    table: str
    path: str
    name: str


def jdbc_targets(manifest: Manifest, schema: str | None = None, exclude_concepts: bool = False,
                 exclude_source_tables: bool = False) -> list[JdbcTarget]:
    """Which tables go where: CDM and concept tables to transfer tables, staging tables
    under their own upper-case names."""
    skipped = {g for g, skip in (("concept", exclude_concepts), ("prepared_source", exclude_source_tables)) if skip}
    targets = []
    for group in JDBC_GROUPS:
        if group in skipped:
            continue
        for table, path in manifest[group].items():
            name = table.upper() if group == "prepared_source" else f"transfer{table.upper()}"
            targets.append(JdbcTarget(group, table, path, f"{schema}.{name}" if schema else name))
    return targets


def write_jdbc(spark: SparkSession, targets: list[JdbcTarget], url: str, properties: Mapping[str, str],
               connections: int = 32, version: str = "5.4", dialect: str | None = None) -> None:
    """Overwrite the targets; at most ``connections`` tasks write to the database at once."""
    for target in targets:
        _load_ready(spark.read.parquet(target.path), target.group, target.table, version, dialect).write.option("numPartitions", connections).jdbc(
            url=url, table=target.name, mode="overwrite", properties=dict(properties)
        )
