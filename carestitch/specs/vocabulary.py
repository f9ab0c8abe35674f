"""Layouts of the vocabulary files (tab-separated, one header line).

Codes stay strings ("0123", "3.01"); the validity dates arrive as yyyymmdd digits.
"""

from __future__ import annotations

from .cdm import cdm_specs
from .table import TableSpec

_FILES = (
    "concept", "concept_relationship", "vocabulary", "concept_ancestor", "concept_class",
    "concept_synonym", "drug_strength", "domain", "relationship",
)


def _as_delivered(spec: TableSpec) -> TableSpec:
    raw = {n: "int" if n in ("valid_start_date", "valid_end_date") else t
           for n, t in spec.columns.items()}
    return TableSpec(spec.name, raw)


VOCABULARY_SPECS = {name: _as_delivered(cdm_specs("5.4")[name]) for name in _FILES}

CONCEPT_MAP_COLUMNS = (
    "source_concept_id", "source_vocabulary_id", "source_vocabulary_version",
    "source_domain_id", "source_concept_code", "source_standard_concept",
    "source_concept_name", "relationship_id", "mapped_concept_id", "mapped_vocabulary_id",
    "mapped_vocabulary_version", "mapped_domain_id", "mapped_standard_concept",
    "mapped_concept_code", "mapped_concept_name",
)

# Code-system identifier → vocabulary.
OID_TO_VOCABULARY = {
    "2.16.840.1.113883.12.1": "Gender",
    "2.16.840.1.114222.4.11.836": "PHVS_RaceCategory_CDC",
    "2.16.840.1.113883.6.301.5": "UB04 Pt dis status",
    "2.16.840.1.113883.12.23": "UB04 Point of Origin",
    "2.16.840.1.113883.12.4": "Patient class (HL7)",
    "2.16.840.1.113883.6.90": "ICD10CM",
    "2.16.840.1.113883.6.103": "ICD9CM",
    "2.16.840.1.113883.6.12": "CPT4",
    "2.16.840.1.113883.6.285": "HCPCS",
    "2.16.840.1.113883.6.104": "ICD9Proc",
    "2.16.840.1.113883.6.4": "ICD10PCS",
    "2.16.840.1.113883.6.1": "LOINC",
    "2.16.840.1.113883.6.96": "SNOMED",
    "2.16.840.1.113883.6.69": "NDC",
    "2.16.840.1.113883.4.642.3.912": "UCUM",
    "2.16.840.1.113883.6.8": "UCUM",
    "2.16.840.1.113883.6.88": "RxNorm",
    "2.16.840.1.113883.12.292": "CVX",
    "ohdsi.race": "Race",
    "ohdsi.ethnicity": "Ethnicity",
    "ohdsi.visit": "Visit",
    "ohdsi.type_concept": "Type Concept",
    "ohdsi.condition_status": "Condition Status",
    "nahdo.sopt": "SOPT",
    "ohdsi.relationship": "Relationship",
    "2.16.840.1.113883.6.101": "NUCC",
    "urn:cerner:codingsystem:cms:medicalspecialty": "Medicare Specialty",
}
