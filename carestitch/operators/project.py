"""Projections and row filters on staging and model tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import TableSpec


def rename_columns(df: DataFrame, names: Mapping[str, str], keep_others: bool = False) -> DataFrame:
    """Project and rename. Order is the mapping's; with ``keep_others`` the table's."""
    if keep_others:
        return df.withColumnsRenamed(dict(names))
    return df.select([F.col(old).alias(new) for old, new in names.items()])


def align(df: DataFrame, spec: TableSpec, keep_others: bool = False) -> DataFrame:
    """Bring a table to a layout: its order, its types, absent columns as typed nulls."""
    have = set(df.columns)
    cols = [
        (F.col(n).try_cast(t) if n in have else F.lit(None).cast(t)).alias(n)
        for n, t in spec.columns.items()
    ]
    others = [F.col(c) for c in df.columns if c not in spec.columns] if keep_others else []
    return df.select(cols + others)


def is_included(flag: str = "i_exclude") -> Column:
    """True unless the row's exclusion flag is 1."""
    return F.col(flag).isNull() | (F.trim(F.col(flag)) != "1")


def exclude_rows(df: DataFrame, flag: str = "i_exclude") -> DataFrame:
    return df.filter(is_included(flag)) if flag in df.columns else df


def stamp_lineage(df: DataFrame, source_table: str, row_id: str = "g_id") -> DataFrame:
    """Name of the staging table and id of the staging row a record came from."""
    return df.withColumns({"g_source_table_name": F.lit(source_table), "s_g_id": F.col(row_id)})


def has_code(code: str, oid: str) -> Column:
    return F.col(code).isNotNull() & F.col(oid).isNotNull()


def split_by_type(value: str, kind: str, wanted: str) -> Column:
    """The value where its type column says ``wanted``, otherwise null."""
    return F.when(F.col(kind) == F.lit(wanted), F.col(value))


def union_by_name(parts: list[DataFrame], fill_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), parts)


def union_distinct(parts: list[DataFrame]) -> DataFrame:
    return union_by_name(parts).distinct()
