"""Registered checks: a Spark query and, where it exists, the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .oracle import oracle_text
from .views import Bridge

QUERIES: dict[str, Callable[[Bridge], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query; ``sql`` is a template over given tables and oracle views."""

    def register(run: Callable[[Bridge], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle_text(sql)
        return run

    return register


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text and doubles rounded, to compare across engines."""
    def plain(name: str, kind: str):
        if kind in ("date", "timestamp", "timestamp_ntz"):
            return F.col(name).cast("string").alias(name)
        return F.round(name, 6).alias(name) if kind == "double" else F.col(name)

    return df.select([plain(n, k) for n, k in df.dtypes])
