"""What each CDM table is made of, as data.

A ``SourceBuild`` names one staging table, how its rows are aligned, which coded fields
are resolved and which CDM tables they feed. A column's value is a column of the aligned
and resolved staging row or a rule of ``functions`` on such columns (``Rule``). Names are those
of CDM 5.4; the builder renames what 5.3.1 spells differently.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import as_date, birth_parts, end_or_start
from ..functions.values import code_label, decimal_value, first_filled, preferred_type
from ..operators.resolve import CodedField

# Position of each staging table in the key of the facts it contributes.
CONTRIBUTORS = ("source_condition", "source_procedure", "source_device", "source_medication", "source_result")

PRIMARY_KEYS = {
    "condition_occurrence": "condition_occurrence_id",
    "procedure_occurrence": "procedure_occurrence_id",
    "drug_exposure": "drug_exposure_id",
    "device_exposure": "device_exposure_id",
    "measurement": "measurement_id",
    "observation": "observation_id",
}

# CDM columns are prefixed with the table's subject.
_SUBJECT = {
    "condition_occurrence": "condition", "procedure_occurrence": "procedure",
    "drug_exposure": "drug", "device_exposure": "device",
    "measurement": "measurement", "observation": "observation",
}


class Rule:
    """A rule on columns and on other rules' values, kept until there is a session."""

    def __init__(self, rule: Callable[..., Column], *args: "Value"):
        self.rule, self.args = rule, args

    def column(self) -> Column:
        return self.rule(*map(column_of, self.args))

    def reads(self) -> set[str]:
        return set().union(*map(columns_read, self.args))


Value = str | Rule


def column_of(value: Value) -> Column:
    return F.col(value) if isinstance(value, str) else value.column()


def columns_read(value: Value) -> set[str]:
    return {value} if isinstance(value, str) else value.reads()


@dataclass(frozen=True)
class Route:
    """One CDM table fed by a staging table.

    domain         keep rows of this domain only
    keep_unmapped  rows without a standard concept go by their source concept's domain
    or_unknown     rows without any domain are kept as well
    """

    table: str
    columns: Mapping[str, Value]
    domain: str | None = None
    keep_unmapped: bool = False
    or_unknown: bool = False


@dataclass(frozen=True)
class SourceBuild:
    source: str
    routes: tuple[Route, ...]
    codes: tuple[CodedField, ...] = ()
    person: bool = True
    visit: str | None = None
    links: Mapping[str, str] = field(default_factory=dict)
    fanout: str | None = None
    domain_column: str | None = None
    row_filter: str | None = None
    derived: Mapping[str, Value] = field(default_factory=dict)


def _birth(part: str) -> Rule:
    return Rule(lambda birth: birth_parts(birth)[part], "s_birth_datetime")


def _two_level(name: str, stem: str | None = None, domain: str | None = None, source: bool = True) -> CodedField:
    """Mapped code first, then source code."""
    stem = stem or name
    return CodedField(
        concept=f"{name}_concept_id", candidates=(f"m_{stem}", f"s_{stem}"),
        source=f"{name}_source_concept_id" if source else None, domain=domain,
    )


def _standard(concept: str, prefix: str) -> CodedField:
    return CodedField(concept=concept, candidates=(prefix,), standard_only=True)


def event_columns(table: str, start: str, end: str | None, code: Value, type_id: str,
                  concept: str = "g_concept_id", source: str = "g_source_concept_id") -> dict[str, Value]:
    """The columns every routed event fills, named by the table's subject."""
    subject = _SUBJECT[table]
    columns = {
        "person_id": "person_id", "visit_occurrence_id": "visit_occurrence_id",
        f"{subject}_concept_id": concept, f"{subject}_source_concept_id": source,
        f"{subject}_source_value": code, f"{subject}_type_concept_id": type_id,
    }
    if table in ("measurement", "observation", "procedure_occurrence"):
        edges = {subject: start}
        if table == "procedure_occurrence" and end:
            edges["procedure_end"] = end
    else:
        stem = subject if table == "condition_occurrence" else table
        edges = {f"{stem}_start": start, **({f"{stem}_end": end} if end else {})}
    for edge, value in edges.items():
        columns |= {f"{edge}_date": Rule(as_date, value), f"{edge}_datetime": value}
    return columns


def _fact_routes(tables: Mapping[str, str], start: str, end: str, code: str, type_id: str,
                 native: str, extra: Mapping[str, str]) -> tuple[Route, ...]:
    routes = []
    for table, domain in tables.items():
        columns = event_columns(table, start, end, code, type_id)
        if table == native:
            columns |= extra
        routes.append(Route(table, columns, domain, keep_unmapped=True))
    return tuple(routes)


LOCATION = SourceBuild(
    "source_location", person=False,
    routes=(Route("location", {
        "location_id": "g_id", "address_1": "s_address_1", "address_2": "s_address_2",
        "city": "s_city", "state": "s_state", "zip": "s_zip", "county": "s_county",
        "country_source_value": "s_country", "latitude": "s_latitude",
        "longitude": "s_longitude", "location_source_value": "k_location",
    }),),
)

CARE_SITE = SourceBuild(
    "source_care_site", person=False, links={"location": "k_location"},
    routes=(Route("care_site", {
        "care_site_id": "g_id", "care_site_name": "s_care_site_name",
        "care_site_source_value": "k_care_site", "location_id": "location_id",
    }),),
)

PROVIDER = SourceBuild(
    "source_provider", person=False, links={"care_site": "k_care_site"},
    codes=(_two_level("gender", domain="Gender"), _two_level("specialty")),
    routes=(Route("provider", {
        "provider_id": "g_id", "provider_name": "s_provider_name", "npi": "s_npi",
        "dea": "s_dea_number", "provider_source_value": "k_provider",
        "care_site_id": "care_site_id", "year_of_birth": _birth("year_of_birth"),
        "specialty_concept_id": "specialty_concept_id",
        "specialty_source_concept_id": "specialty_source_concept_id",
        "gender_source_value": "s_gender", "gender_concept_id": "gender_concept_id",
        "gender_source_concept_id": "gender_source_concept_id",
    }),),
)

PERSON = SourceBuild(
    "source_person", person=False, links={"location": "k_location"},
    codes=(
        _two_level("gender", domain="Gender"), _two_level("race", domain="Race"),
        _two_level("ethnicity", domain="Ethnicity"),
    ),
    routes=(Route("person", {
        "person_id": "g_person_id", "person_source_value": "s_person_id",
        **{part: _birth(part) for part in ("year_of_birth", "month_of_birth", "day_of_birth")}, "birth_datetime": "s_birth_datetime",
        "location_id": "location_id",
        **{f"{c}_source_value": f"s_{c}" for c in ("gender", "race", "ethnicity")},
        **{f"{c}_{k}": f"{c}_{k}" for c in ("gender", "race", "ethnicity")
           for k in ("concept_id", "source_concept_id")},
    }),),
)

DEATH = SourceBuild(
    "source_person", person=False, row_filter="s_death_datetime is not null",
    codes=(_standard("death_type_concept_id", "m_death_source"),),
    routes=(Route("death", {
        "person_id": "g_person_id", "death_date": Rule(as_date, "s_death_datetime"),
        "death_datetime": "s_death_datetime",
        "death_type_concept_id": "death_type_concept_id",
    }),),
)

VISIT = SourceBuild(
    "source_encounter", links={"care_site": "k_care_site", "provider": "k_provider"},
    codes=(
        _two_level("visit", "visit_type", domain="Visit"),
        _standard("visit_type_concept_id", "m_visit_source"),
        _two_level("admitted_from", "admitting_source", source=False),
        _two_level("discharged_to", "discharge_to", source=False),
    ),
    routes=(Route("visit_occurrence", {
        "visit_occurrence_id": "g_visit_id", "person_id": "person_id",
        "visit_concept_id": "visit_concept_id",
        "visit_source_concept_id": "visit_source_concept_id",
        "visit_type_concept_id": "visit_type_concept_id",
        "visit_start_date": Rule(as_date, "s_visit_start_datetime"),
        "visit_start_datetime": "s_visit_start_datetime",
        "visit_end_date": Rule(end_or_start, "s_visit_end_datetime", "s_visit_start_datetime"),
        "visit_end_datetime": "s_visit_end_datetime", "visit_source_value": "s_visit_type",
        "admitted_from_source_value": "s_admitting_source",
        "admitted_from_concept_id": "admitted_from_concept_id",
        "discharged_to_source_value": "s_discharge_to",
        "discharged_to_concept_id": "discharged_to_concept_id",
        "care_site_id": "care_site_id", "provider_id": "provider_id",
    }),),
)

OBSERVATION_PERIOD = SourceBuild(
    "source_observation_period", codes=(_standard("period_type_concept_id", "m_source"),),
    routes=(Route("observation_period", {
        "observation_period_id": "g_id", "person_id": "person_id",
        "observation_period_start_date": Rule(as_date, "s_start_observation_datetime"),
        "observation_period_end_date": Rule(as_date, "s_end_observation_datetime"),
        "period_type_concept_id": "period_type_concept_id",
    }),),
)

PAYER_PLAN_PERIOD = SourceBuild(
    "source_payer", codes=(_two_level("payer"),),
    routes=(Route("payer_plan_period", {
        "payer_plan_period_id": "g_id", "person_id": "person_id",
        "payer_plan_period_start_date": Rule(as_date, "s_payer_start_datetime"),
        "payer_plan_period_end_date": Rule(as_date, Rule(first_filled, "s_payer_end_datetime", "s_payer_start_datetime")),
        "payer_source_value": "s_payer", "payer_concept_id": "payer_concept_id",
        "payer_source_concept_id": "payer_source_concept_id",
    }),),
)

VISIT_DETAIL = SourceBuild(
    "source_encounter_detail", visit="inner", links={"care_site": "k_care_site"},
    codes=(
        _two_level("visit_detail", "visit_detail_type", domain="Visit"),
        _standard("visit_detail_type_concept_id", "m_visit_detail_source"),
    ),
    routes=(Route("visit_detail", {
        "visit_detail_id": "g_id", "person_id": "person_id",
        "visit_occurrence_id": "visit_occurrence_id",
        "visit_detail_concept_id": "visit_detail_concept_id",
        "visit_detail_source_concept_id": "visit_detail_source_concept_id",
        "visit_detail_type_concept_id": "visit_detail_type_concept_id",
        "visit_detail_start_date": Rule(as_date, "s_start_datetime"),
        "visit_detail_start_datetime": "s_start_datetime",
        "visit_detail_end_date": Rule(end_or_start, "s_end_datetime", "s_start_datetime"),
        "visit_detail_end_datetime": "s_end_datetime",
        "visit_detail_source_value": "s_visit_detail_type", "care_site_id": "care_site_id",
    }),),
)

CONDITION = SourceBuild(
    "source_condition", visit="left", links={"provider": "k_provider"}, fanout="s_condition",
    codes=(
        _standard("condition_type_concept_id", "m_condition_type"),
        _two_level("condition_status", source=False),
    ),
    routes=_fact_routes(
        {"condition_occurrence": "Condition", "procedure_occurrence": "Procedure",
         "observation": "Observation", "measurement": "Measurement"},
        "s_start_condition_datetime", "s_end_condition_datetime", "s_condition_code",
        "condition_type_concept_id", native="condition_occurrence",
        extra={"provider_id": "provider_id",
               "condition_status_concept_id": "condition_status_concept_id",
               "condition_status_source_value": "s_condition_status"},
    ),
)

PROCEDURE = SourceBuild(
    "source_procedure", visit="left", links={"provider": "k_provider"}, fanout="s_procedure",
    codes=(_standard("procedure_type_concept_id", "m_procedure_type"),),
    routes=_fact_routes(
        {"procedure_occurrence": "Procedure", "drug_exposure": "Drug",
         "measurement": "Measurement", "observation": "Observation", "device_exposure": "Device"},
        "s_start_procedure_datetime", "s_end_procedure_datetime", "s_procedure_code",
        "procedure_type_concept_id", native="procedure_occurrence",
        extra={"provider_id": "provider_id"},
    ),
)

DEVICE = SourceBuild(
    "source_device", visit="left", domain_column="g_device_domain_id",
    codes=(
        _standard("device_type_concept_id", "m_device_type"),
        CodedField("device_concept_id", ("m_device", "s_device"), "device_source_concept_id",
                   mapped_domain="g_device_domain_id"),
    ),
    routes=(Route("device_exposure", {
        **event_columns("device_exposure", "s_start_device_datetime", "s_end_device_datetime",
                        "s_device_code", "device_type_concept_id",
                        "device_concept_id", "device_source_concept_id"),
        "unique_device_id": "s_unique_device_identifier",
    }, domain="Device"),),
)

MEDICATION = SourceBuild(
    "source_medication", visit="left", links={"provider": "k_provider"},
    domain_column="g_drug_domain_id",
    codes=(
        _standard("m_type_concept_id", "m_drug_type"), _standard("s_type_concept_id", "s_drug_type"),
        _two_level("route", domain="Route", source=False),
        CodedField("drug_concept_id", ("m_drug", "s_drug", "g_drug"), "drug_source_concept_id",
                   domain="Drug", mapped_domain="g_drug_domain_id"),
    ),
    derived={
        "g_type_concept_id": Rule(preferred_type, "m_type_concept_id", "s_type_concept_id"),
        "g_drug_label": Rule(code_label, Rule(first_filled, "s_drug_code", "m_drug_code", "g_drug_code"),
                             Rule(first_filled, "s_drug_text", "s_drug_alternative_text", "m_drug_text", "g_drug_text")),
    },
    routes=(Route("drug_exposure", {
        **event_columns("drug_exposure", "s_start_medication_datetime", "s_end_medication_datetime",
                        "g_drug_label", "g_type_concept_id", "drug_concept_id", "drug_source_concept_id"),
        "provider_id": "provider_id", "route_concept_id": "route_concept_id",
        "route_source_value": "s_route", "stop_reason": "s_status", "quantity": "s_quantity",
        "dose_unit_source_value": "s_dose_unit",
    }, domain="Drug", or_unknown=True),),
)

_RESULT_VALUES = {
    "value_as_concept_id": "value_as_concept_id",
    "value_as_number": Rule(decimal_value, "m_result_numeric", "s_result_numeric"),
    "unit_concept_id": "unit_concept_id",
}
_RESULT_EVENT = ("s_obtained_datetime", None, Rule(first_filled, "m_code", "s_code"), "measurement_type_concept_id",
                 "measurement_concept_id", "measurement_source_concept_id")
RESULT = SourceBuild(
    "source_result", visit="left", domain_column="g_result_domain_id",
    codes=(
        _standard("measurement_type_concept_id", "m_source"),
        _two_level("unit", "result_unit", domain="Unit", source=False),
        _two_level("value_as", "result", source=False),
        _standard("operator_concept_id", "m_operator"),
        CodedField("measurement_concept_id", ("m", "s"), "measurement_source_concept_id",
                   mapped_domain="g_result_domain_id"),
    ),
    routes=(
        Route("measurement", {
            **event_columns("measurement", *_RESULT_EVENT), **_RESULT_VALUES,
            "value_source_value": Rule(first_filled, "m_result_text", "s_result_text"),
            "unit_source_value": Rule(first_filled, "m_result_unit", "s_result_unit"),
            "range_low": "s_result_numeric_lower", "range_high": "s_result_numeric_upper",
            "operator_concept_id": "operator_concept_id",
        }, domain="Measurement"),
        Route("observation", {
            **event_columns("observation", *_RESULT_EVENT), **_RESULT_VALUES,
            "value_as_string": Rule(first_filled, "m_result_text", "s_result_text"),
            "unit_source_value": "s_result_unit",
        }, domain="Observation"),
    ),
)

NOTE = SourceBuild(
    "source_note", visit="left",
    codes=(
        _standard("note_class_concept_id", "m_note_class"),
        _standard("language_concept_id", "s_language"),
        _standard("encoding_concept_id", "s_encoding"),
        _standard("note_type_concept_id", "s_note_type"),
    ),
    routes=(Route("note", {
        "note_id": "g_id", "person_id": "person_id",
        "visit_occurrence_id": "visit_occurrence_id",
        "note_date": Rule(as_date, "s_note_datetime"), "note_datetime": "s_note_datetime",
        "note_class_concept_id": "note_class_concept_id",
        "encoding_concept_id": "encoding_concept_id",
        "language_concept_id": "language_concept_id",
        "note_type_concept_id": "note_type_concept_id",
        "note_source_value": "s_note_class", "note_title": "s_note_title",
        "note_text": "s_note_text",
    }),),
)

DIMENSIONS = (
    LOCATION, CARE_SITE, PROVIDER, PERSON, DEATH, VISIT, OBSERVATION_PERIOD,
    PAYER_PLAN_PERIOD, VISIT_DETAIL, NOTE,
)
FACTS = (CONDITION, PROCEDURE, DEVICE, MEDICATION, RESULT)

# Tables delivered without rows, by version.
EMPTY_TABLES = (
    "dose_era", "drug_era", "condition_era", "specimen", "note_nlp", "cost",
    "cohort_definition", "metadata",
)
EMPTY_BY_VERSION = {"5.3.1": ("attribute_definition",), "5.4": ("episode", "episode_event")}
