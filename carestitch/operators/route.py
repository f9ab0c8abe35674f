"""Routing of matched facts to the table of their domain, and combining them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import TableSpec
from .project import align, union_by_name


def in_domain(domain: str, keep_unmapped: bool = True) -> Column:
    """Rows whose standard concept is of the domain; unmapped rows go by their source
    concept's domain unless ``keep_unmapped`` is off."""
    mapped = F.col("mapped_domain_id") == F.lit(domain)
    if not keep_unmapped:
        return mapped
    return mapped | (F.col("mapped_domain_id").isNull() & (F.col("domain_id") == F.lit(domain)))


def in_domain_or_unknown(domain: str) -> Column:
    """Rows whose concept is of the domain, and those without any."""
    return F.col("mapped_domain_id").isNull() | (F.col("mapped_domain_id") == F.lit(domain))


def combine(parts: list[DataFrame], spec: TableSpec) -> DataFrame:
    """All contributions to one table, brought to its layout and joined by column name."""
    return union_by_name([align(part, spec) for part in parts])
