"""Output folders by run, so that readers of a manifest see one finished run and nothing of another.

A run writes below a folder of its own and its manifest is swapped last, in one rename. A run that stops leaves the
manifest before it, and the tables that it names, as they were.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

_PREFIX = "run-"


def new_version(base: str) -> str:
    """A new folder name below an output location; names sort by the time of their run."""
    at = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{base.rstrip('/')}/{_PREFIX}{at}-{uuid.uuid4().hex[:8]}"


def versions(spark: SparkSession, base: str) -> list[str]:
    """The names of the run folders below an output location, oldest first."""
    place = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()]
    return sorted(n for n in found if n.startswith(_PREFIX))


def prune_versions(spark: SparkSession, base: str, current: str, keep: int) -> list[str]:
    """Remove runs older than ``current`` but for the last ``keep - 1`` of them; returns the names removed.

    Newer folders belong to runs under way and stay, as does everything that is no run folder.
    """
    if keep < 1:
        raise ValueError("at least the current run is kept")
    older = [n for n in versions(spark, base) if n < current.rstrip("/").rpartition("/")[2]]
    gone = older[:max(0, len(older) - (keep - 1))]
    for name in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone
