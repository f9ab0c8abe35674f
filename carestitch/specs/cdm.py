"""Layouts of the common data model by version, and the lineage columns of its rows."""

from __future__ import annotations

from functools import cache

from . import cdm_54, cdm_531
from .table import TableSpec

LINEAGE = {"s_id": "string", "g_source_table_name": "string", "s_g_id": "bigint"}

_LAYOUTS = {"5.3.1": cdm_531.LAYOUTS, "5.4": cdm_54.LAYOUTS}
# Columns of 5.4 that 5.3.1 names differently.
NAMES_IN_531 = {
    "admitted_from_concept_id": "admitting_source_concept_id",
    "admitted_from_source_value": "admitting_source_value",
    "discharged_to_concept_id": "discharge_to_concept_id",
    "discharged_to_source_value": "discharge_to_source_value",
    "parent_visit_detail_id": "visit_detail_parent_id",
}
CDM_VERSIONS = tuple(_LAYOUTS)


def normalise_version(version: str) -> str:
    """5.4.1 is accepted as another name of 5.4."""
    wanted = "5.4" if version == "5.4.1" else version
    if wanted not in CDM_VERSIONS:
        raise ValueError(f"CDM version {version!r}: only {', '.join(CDM_VERSIONS)} (or 5.4.1)")
    return wanted


@cache
def cdm_specs(version: str = "5.4") -> dict[str, TableSpec]:
    return {
        table: TableSpec(table, dict(column.split() for column in ddl.split(",")))
        for table, ddl in _LAYOUTS[normalise_version(version)].items()
    }


def cdm_spec(table: str, version: str = "5.4") -> TableSpec:
    """Layout of one CDM table followed by the row-lineage columns."""
    base = cdm_specs(version)[table]
    return TableSpec(table, {**base.columns, **LINEAGE})
