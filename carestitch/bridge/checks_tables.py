"""Checks of the CDM tables: business columns of every built table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.project import union_by_name
from ..operators.route import in_domain
from ..plans import builds as B
from ..plans.relationships import Relationship, build_fact_relationship, unknown_links
from ..specs import cdm_specs
from .oracle import day, moment, routed
from .registry import check, portable
from .views import Bridge


def _dimension(build: B.SourceBuild, view: str, columns: str) -> None:
    """A dimension-like table, compared on the given columns."""
    (route,) = build.routes
    names = columns.split()

    @check(f"build_{route.table}", f"select {', '.join(names)} from {{{view}}}")
    def _(b: Bridge):
        return portable(b.plans.contribution(build, route.table).select(*names))


_dimension(B.LOCATION, "o_location", (
    "location_id address_1 city state county country_source_value latitude longitude location_source_value"))
_dimension(B.CARE_SITE, "o_care_site", "care_site_id care_site_name care_site_source_value location_id")
_dimension(B.PROVIDER, "o_provider", (
    "provider_id provider_name npi provider_source_value care_site_id year_of_birth specialty_concept_id "
    "specialty_source_concept_id gender_source_value gender_concept_id gender_source_concept_id"))
_dimension(B.PERSON, "o_person", (
    "person_id person_source_value year_of_birth month_of_birth day_of_birth birth_datetime location_id "
    "gender_source_value gender_concept_id gender_source_concept_id race_source_value race_concept_id "
    "race_source_concept_id ethnicity_source_value ethnicity_concept_id ethnicity_source_concept_id s_id"))
_dimension(B.DEATH, "o_death", "person_id death_date death_datetime death_type_concept_id")
_dimension(B.VISIT, "o_visit", (
    "visit_occurrence_id person_id visit_concept_id visit_source_concept_id visit_type_concept_id "
    "visit_start_date visit_start_datetime visit_end_date visit_end_datetime visit_source_value "
    "admitted_from_source_value admitted_from_concept_id discharged_to_source_value "
    "discharged_to_concept_id care_site_id provider_id s_id"))
_dimension(B.OBSERVATION_PERIOD, "o_observation_period", (
    "observation_period_id person_id observation_period_start_date observation_period_end_date "
    "period_type_concept_id"))
_dimension(B.PAYER_PLAN_PERIOD, "o_payer", (
    "payer_plan_period_id person_id payer_plan_period_start_date payer_plan_period_end_date "
    "payer_source_value payer_concept_id payer_source_concept_id"))
_dimension(B.VISIT_DETAIL, "o_visit_detail", (
    "person_id visit_occurrence_id visit_detail_concept_id visit_detail_source_concept_id "
    "visit_detail_type_concept_id visit_detail_start_date visit_detail_end_date "
    "visit_detail_source_value care_site_id s_id"))
_dimension(B.NOTE, "o_note", (
    "person_id visit_occurrence_id note_date note_datetime note_class_concept_id language_concept_id "
    "note_type_concept_id encoding_concept_id note_source_value note_title note_text s_id"))


def _older(table: str, view: str, columns: dict[str, str]) -> None:
    """A table of version 5.3.1, all its columns in their order asked for by name."""
    names = ", ".join(f"{expression} as {name}" for name, expression in columns.items())

    @check(f"build_{table}_531", f"select {names} from {{{view}}}")
    def _(b: Bridge):
        built = b.plans_531._build(table)
        layout = list(cdm_specs("5.3.1")[table].columns)
        assert built.columns[:len(layout)] == layout, (table, built.columns)
        return portable(built.select(*columns))


_SAME = lambda names: {n: n for n in names.split()}
_older("location", "o_location", _SAME("location_id address_1 city state county location_source_value"))
_older("visit_occurrence", "o_visit", _SAME(
    "visit_occurrence_id person_id visit_concept_id visit_type_concept_id visit_start_date visit_source_value s_id") | {
    "admitting_source_value": "admitted_from_source_value", "admitting_source_concept_id": "admitted_from_concept_id",
    "discharge_to_source_value": "discharged_to_source_value", "discharge_to_concept_id": "discharged_to_concept_id"})
for _table, _subject in (("procedure_occurrence", "procedure"), ("drug_exposure", "drug"), ("observation", "observation")):
    _older(_table, f"o_{_table}", _SAME("person_id visit_occurrence_id s_id") | {
        f"{_subject}_concept_id": "concept_id", f"{_subject}_source_concept_id": "source_concept_id",
        f"{_subject}_source_value": "code", f"{_subject}_type_concept_id": "type_concept_id"})


@check("build_visit_source_link",
       "select visit_occurrence_id, s_encounter_id, person_id, s_person_id from {o_link}")
def _(b: Bridge):
    return b.plans._build("visit_source_link")


def _fact(table: str, start: str, end: str | None, extra: str) -> None:
    """A combined table with the columns all its sources fill and some of one source."""
    subject = {"condition_occurrence": "condition", "procedure_occurrence": "procedure",
               "drug_exposure": "drug", "device_exposure": "device"}.get(table, table)
    common = {
        "person_id": "person_id", "visit_occurrence_id": "visit_occurrence_id",
        f"{subject}_concept_id": "concept_id", f"{subject}_source_concept_id": "source_concept_id",
        f"{subject}_source_value": "code", f"{subject}_type_concept_id": "type_concept_id",
        f"{start}_date": "start_date", "g_source_table_name": "g_source_table_name", "s_id": "s_id",
        f"{start}_datetime": moment("started"),
    }
    if end:
        common |= {f"{end}_date": day("substr(ended, 1, 10)")}
    common |= {c: c for c in extra.split()}
    columns = ", ".join(f"{expression} as {name}" for name, expression in common.items())

    @check(f"build_{table}", f"select {columns} from {{o_{table}}}")
    def _(b: Bridge):
        return portable(b.plans._build(table).select(*common))


_fact("condition_occurrence", "condition_start", "condition_end",
      "provider_id condition_status_concept_id condition_status_source_value")
_fact("procedure_occurrence", "procedure", "procedure_end", "provider_id")
_fact("drug_exposure", "drug_exposure_start", "drug_exposure_end",
      "provider_id route_concept_id route_source_value stop_reason quantity dose_unit_source_value")
_fact("device_exposure", "device_exposure_start", "device_exposure_end", "unique_device_id")
_fact("measurement", "measurement", None,
      "value_as_number unit_concept_id value_as_concept_id value_source_value unit_source_value range_low range_high")
_fact("observation", "observation", None,
      "value_as_number unit_concept_id value_as_concept_id value_as_string unit_source_value")


def _route(name: str, build: B.SourceBuild, table: str, view: str, domain: str) -> None:
    """One route of one staging table: rows and concepts that reach the table."""
    subject = table.split("_")[0]

    @check(name, f"select m.s_id, m.person_id, m.concept_id, m.source_concept_id from {{{view}}} m "
                 f"where {routed(domain, view)}")
    def _(b: Bridge):
        return b.plans.contribution(build, table).select(
            "s_id", "person_id", F.col(f"{subject}_concept_id").alias("concept_id"),
            F.col(f"{subject}_source_concept_id").alias("source_concept_id"))


_route("route_condition", B.CONDITION, "condition_occurrence", "m_condition", "Condition")
_route("route_procedure", B.PROCEDURE, "procedure_occurrence", "m_procedure", "Procedure")
_route("route_drug", B.PROCEDURE, "drug_exposure", "m_procedure", "Drug")
_route("route_measurement", B.RESULT, "measurement", "m_result", "Measurement")
_route("route_observation", B.RESULT, "observation", "m_result", "Observation")
_route("route_device", B.DEVICE, "device_exposure", "m_device", "Device")
_route("route_drug_keep_unmapped", B.MEDICATION, "drug_exposure", "m_medication", "Drug")


@check("route_condition_mapped_only", "select m.s_id, m.concept_id from {m_condition} m where m.mapped_domain_id = 'Condition'")
def _(b: Bridge):
    """Without the rows that have no standard concept."""
    rows = b.plans.matched(B.CONDITION).filter(in_domain("Condition", keep_unmapped=False))
    return rows.select("s_id", F.col("g_concept_id").alias("concept_id"))


def relationship_frame(b: Bridge, cdm):
    return build_fact_relationship(
        b("source_relationship"), [Relationship("payer", "payer_plan_period", "visit_occurrence")],
        b, cdm, b("concept"), b("oid_map"),
    )


@check("fact_relationship", "select * from {o_fact_relationship}")
def _(b: Bridge):
    return relationship_frame(b, b.plans.table)


@check("fact_relationship_two_codes", """select 3000002 as domain_concept_id_1, p.payer_plan_period_id as fact_id_1,
        3000001 as domain_concept_id_2, v.visit_occurrence_id as fact_id_2,
        case when right(r.s_target_to_value, 1) in ('0', '2', '4', '6', '8') then 3000003 else 0 end as relationship_concept_id
        from {source_relationship} r join {o_payer} p on p.s_id = r.s_target_from_value
        join {o_link} v on v.s_encounter_id = r.s_target_to_value""")
def _(b: Bridge):
    """A second, unknown code under the same name and tables: all rows stay linked, each with its code's concept."""
    even = F.right("s_target_to_value", F.lit(1)).isin("0", "2", "4", "6", "8")
    links = b("source_relationship").withColumn("s_relationship_code", F.when(even, F.col("s_relationship_code")).otherwise("none"))
    return build_fact_relationship(links, [Relationship("payer", "payer_plan_period", "visit_occurrence")], b, b.plans.table, b("concept"), b("oid_map"))


@check("unknown_links", """select 'payer' as s_relationship, 'source_payer' as s_target_from_table_name,
        'no_column' as s_target_from_table_field, count(*) as n_rows from {source_relationship}""")
def _(b: Bridge):
    """Links that name a column which isn't there are counted, not an error."""
    links = b("source_relationship").withColumn("s_target_from_table_field", F.lit("no_column"))
    return unknown_links(links, b).select("s_relationship", "s_target_from_table_name", "s_target_from_table_field", "n_rows")


@check("combine_domains", " union all ".join(
    f"select '{t}' as cdm_table, g_source_table_name, count(*) as n_rows, count(*) as n_keys "
    f"from {{o_{t}}} group by g_source_table_name" for t in B.PRIMARY_KEYS))
def _(b: Bridge):
    """Rows and distinct keys per combined table and contributing source."""
    parts = [
        b.cdm.table(table).groupBy(F.lit(table).alias("cdm_table"), "g_source_table_name").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"))
        for table, key in B.PRIMARY_KEYS.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_VIEWS = {"visit_occurrence": "o_visit", "payer_plan_period": "o_payer", "visit_source_link": "o_link"}


def _rows_of_tables() -> str:
    built = [build.routes[0].table for build in B.DIMENSIONS] + list(B.PRIMARY_KEYS)
    counts = [f"select '{t}' as cdm_table, count(*) as n_rows, {len(cdm_specs('5.4')[t].columns)} as n_columns from {{{_VIEWS.get(t, f'o_{t}')}}}" for t in built]
    counts += [f"select '{t}', 0, {len(cdm_specs('5.4')[t].columns)}" for t in (*B.EMPTY_TABLES, *B.EMPTY_BY_VERSION["5.4"])]
    return " union all ".join(counts)


@check("cdm_table_rows", _rows_of_tables())
def _(b: Bridge):
    """Rows of every table of a run and how many of its columns are those of the standard, in order; some come without rows."""
    parts = []
    for table in b.cdm.table_names():
        wanted = list(cdm_specs("5.4")[table].columns)
        df = b.cdm.table(table)
        in_order = sum(a == w for a, w in zip(df.columns, wanted, strict=False))
        parts.append(df.agg(F.lit(table).alias("cdm_table"), F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(in_order)))
    return union_by_name(parts)
