"""The checks' SQL side: vocabulary, resolution and model tables in plain SQL."""

from __future__ import annotations

from .views import BASE_TABLES, VIEWS, dependencies


def hit(alias: str, prefix: str, row: str = "x") -> str:
    """Left join of the concept a coded field names."""
    return (
        f" left join {{best}} {alias} on {alias}.oid = {row}.{prefix}_code_type_oid"
        f" and {alias}.concept_code = {row}.{prefix}_code"
    )


def winner(column: str, *aliases: str) -> str:
    """The column of the first candidate that is a known concept, or 0."""
    cases = " ".join(f"when {a}.concept_id is not null then coalesce({a}.{column}, 0)" for a in aliases)
    return f"case {cases} else 0 end"


def winner_domain(*aliases: str) -> str:
    cases = " ".join(f"when {a}.concept_id is not null then {a}.mapped_domain_id" for a in aliases)
    return f"case {cases} end"


def in_domain(domain: str, *aliases: str) -> str:
    """Standard concept of the winner, 0 when it is of another domain."""
    return (
        f"case when {winner_domain(*aliases)} <> '{domain}' then 0 "
        f"else {winner('mapped_concept_id', *aliases)} end"
    )


def day(text: str) -> str:
    return f"cast(try_cast({text} as date) as varchar)"


def moment(text: str) -> str:
    return f"cast(try_cast({text} as timestamp) as varchar)"


_KEPT = "(x.i_exclude is null or x.i_exclude <> '1')"
_WITH_PERSON = " join {o_person} p on p.person_source_value = x.s_person_id"
_WITH_VISIT = (
    " left join {o_link} v on v.s_encounter_id = x.s_encounter_id and v.s_person_id = x.s_person_id"
)

ORACLE_VIEWS = {
    "coded": """select o.oid, c.concept_code, c.concept_id, c.vocabulary_id, c.standard_concept, c.domain_id
        from {concept} c join {oid_map} o on o.vocabulary_id = c.vocabulary_id""",
    "cmap": """select c1.concept_id as source_concept_id, c1.vocabulary_id as source_vocabulary_id,
          v1.vocabulary_version as source_vocabulary_version, c1.domain_id as source_domain_id,
          c1.concept_code as source_concept_code, c1.standard_concept as source_standard_concept,
          c1.concept_name as source_concept_name, r.relationship_id,
          c2.concept_id as mapped_concept_id, c2.vocabulary_id as mapped_vocabulary_id,
          v2.vocabulary_version as mapped_vocabulary_version, c2.domain_id as mapped_domain_id,
          c2.standard_concept as mapped_standard_concept, c2.concept_code as mapped_concept_code,
          c2.concept_name as mapped_concept_name
        from {concept_relationship} r
        join {concept} c1 on c1.concept_id = r.concept_id_1 join {concept} c2 on c2.concept_id = r.concept_id_2
        join {vocabulary} v1 on v1.vocabulary_id = c1.vocabulary_id
        join {vocabulary} v2 on v2.vocabulary_id = c2.vocabulary_id
        where r.relationship_id in ('Maps to', 'Maps to value')""",
    "best": """select c.oid, c.concept_code, c.concept_id, c.domain_id,
          case when c.standard_concept = 'S' then c.concept_id end as standard_only_id,
          t.mapped_concept_id, t.mapped_domain_id
        from {coded} c left join (
          select *, row_number() over (partition by source_concept_id
            order by relationship_id, mapped_concept_id) as nth from {cmap}) t
          on t.source_concept_id = c.concept_id and t.nth = 1""",
    "fanout": """select c.oid, c.concept_code, c.vocabulary_id, c.concept_id, c.standard_concept, c.domain_id,
          t.mapped_concept_id, t.mapped_vocabulary_id, t.mapped_domain_id, t.relationship_id
        from {coded} c left join {cmap} t on t.source_concept_id = c.concept_id""",
    "o_location": """select g_id as location_id, s_address_1 as address_1, s_city as city, s_state as state,
          s_county as county, s_country as country_source_value, cast(s_latitude as double) as latitude,
          cast(s_longitude as double) as longitude, k_location as location_source_value from {source_location}""",
    "o_care_site": """select x.g_id as care_site_id, x.s_care_site_name as care_site_name,
          x.k_care_site as care_site_source_value, l.location_id
        from {source_care_site} x left join {o_location} l on l.location_source_value = x.k_location""",
    "o_provider": f"""select x.g_id as provider_id, x.s_provider_name as provider_name, x.s_npi as npi,
          x.k_provider as provider_source_value, c.care_site_id,
          cast(extract(year from cast(x.s_birth_datetime as date)) as int) as year_of_birth,
          {winner('mapped_concept_id', 'sp')} as specialty_concept_id,
          {winner('concept_id', 'sp')} as specialty_source_concept_id,
          x.s_gender as gender_source_value,
          {in_domain('Gender', 'ge')} as gender_concept_id, {winner('concept_id', 'ge')} as gender_source_concept_id
        from {{source_provider}} x left join {{o_care_site}} c on c.care_site_source_value = x.k_care_site
        {hit('sp', 's_specialty')} {hit('ge', 's_gender')} where {_KEPT}""",
    "o_person": f"""select x.g_id as person_id, x.s_person_id as person_source_value,
          cast(extract(year from cast(x.s_birth_datetime as timestamp)) as int) as year_of_birth,
          cast(extract(month from cast(x.s_birth_datetime as timestamp)) as int) as month_of_birth,
          cast(extract(day from cast(x.s_birth_datetime as timestamp)) as int) as day_of_birth,
          {moment('x.s_birth_datetime')} as birth_datetime, l.location_id,
          x.s_gender as gender_source_value, x.s_race as race_source_value, x.s_ethnicity as ethnicity_source_value,
          {in_domain('Gender', 'g1', 'g2')} as gender_concept_id,
          {winner('concept_id', 'g1', 'g2')} as gender_source_concept_id,
          {in_domain('Race', 'ra')} as race_concept_id, {winner('concept_id', 'ra')} as race_source_concept_id,
          {in_domain('Ethnicity', 'et')} as ethnicity_concept_id,
          {winner('concept_id', 'et')} as ethnicity_source_concept_id, x.s_id, x.s_death_datetime
        from {{source_person}} x left join {{o_location}} l on l.location_source_value = x.k_location
        {hit('g1', 'm_gender')} {hit('g2', 's_gender')} {hit('ra', 's_race')} {hit('et', 's_ethnicity')}
        where {_KEPT}""",
    "o_death": f"""select x.g_id as person_id, {day('substr(x.s_death_datetime, 1, 10)')} as death_date,
          {moment('x.s_death_datetime')} as death_datetime, coalesce(d.standard_only_id, 0) as death_type_concept_id
        from {{source_person}} x {hit('d', 'm_death_source')}
        where x.s_death_datetime is not null and {_KEPT}""",
    "o_visit": f"""select x.g_id as visit_occurrence_id, p.person_id, x.s_encounter_id, x.s_person_id,
          {in_domain('Visit', 'vi')} as visit_concept_id, {winner('concept_id', 'vi')} as visit_source_concept_id,
          coalesce(ty.standard_only_id, 0) as visit_type_concept_id,
          {day('substr(x.s_visit_start_datetime, 1, 10)')} as visit_start_date,
          {moment('x.s_visit_start_datetime')} as visit_start_datetime,
          {day('substr(coalesce(x.s_visit_end_datetime, x.s_visit_start_datetime), 1, 10)')} as visit_end_date,
          {moment('x.s_visit_end_datetime')} as visit_end_datetime, x.s_visit_type as visit_source_value,
          x.s_admitting_source as admitted_from_source_value,
          {winner('mapped_concept_id', 'ad')} as admitted_from_concept_id,
          x.s_discharge_to as discharged_to_source_value,
          {winner('mapped_concept_id', 'di')} as discharged_to_concept_id,
          c.care_site_id, pr.provider_id, x.s_id
        from {{source_encounter}} x {_WITH_PERSON}
        left join {{o_care_site}} c on c.care_site_source_value = x.k_care_site
        left join {{o_provider}} pr on pr.provider_source_value = x.k_provider
        {hit('vi', 's_visit_type')} {hit('ty', 'm_visit_source')} {hit('ad', 's_admitting_source')}
        {hit('di', 's_discharge_to')} where {_KEPT}""",
    "o_link": f"""select x.g_id as visit_occurrence_id, x.s_encounter_id, p.person_id, x.s_person_id
        from {{source_encounter}} x {_WITH_PERSON} where {_KEPT}""",
    "o_observation_period": f"""select x.g_id as observation_period_id, p.person_id,
          {day('substr(x.s_start_observation_datetime, 1, 10)')} as observation_period_start_date,
          {day('substr(x.s_end_observation_datetime, 1, 10)')} as observation_period_end_date,
          coalesce(ty.standard_only_id, 0) as period_type_concept_id
        from {{source_observation_period}} x {_WITH_PERSON} {hit('ty', 'm_source')}""",
    "o_payer": f"""select x.g_id as payer_plan_period_id, p.person_id, x.s_id,
          {day('substr(x.s_payer_start_datetime, 1, 10)')} as payer_plan_period_start_date,
          {day('substr(coalesce(x.s_payer_end_datetime, x.s_payer_start_datetime), 1, 10)')} as payer_plan_period_end_date,
          x.s_payer as payer_source_value, {winner('mapped_concept_id', 'py')} as payer_concept_id,
          {winner('concept_id', 'py')} as payer_source_concept_id
        from {{source_payer}} x {_WITH_PERSON} {hit('py', 's_payer')}""",
    "o_visit_detail": f"""select p.person_id, v.visit_occurrence_id, x.s_id,
          {in_domain('Visit', 'vi')} as visit_detail_concept_id,
          {winner('concept_id', 'vi')} as visit_detail_source_concept_id,
          coalesce(ty.standard_only_id, 0) as visit_detail_type_concept_id,
          {day('substr(x.s_start_datetime, 1, 10)')} as visit_detail_start_date,
          {day('substr(coalesce(x.s_end_datetime, x.s_start_datetime), 1, 10)')} as visit_detail_end_date,
          x.s_visit_detail_type as visit_detail_source_value, c.care_site_id
        from {{source_encounter_detail}} x {_WITH_PERSON}
        join {{o_link}} v on v.s_encounter_id = x.s_encounter_id and v.s_person_id = x.s_person_id
        left join {{o_care_site}} c on c.care_site_source_value = x.k_care_site
        {hit('vi', 's_visit_detail_type')} {hit('ty', 'm_visit_detail_source')}""",
    "m_condition": f"""select 'source_condition' as g_source_table_name, x.*, p.person_id, v.visit_occurrence_id,
          pr.provider_id, coalesce(ty.standard_only_id, 0) as type_concept_id,
          {winner('mapped_concept_id', 'cs')} as condition_status_concept_id,
          coalesce(t.concept_id, 0) as source_concept_id, coalesce(t.mapped_concept_id, 0) as concept_id,
          t.mapped_domain_id, t.domain_id, t.relationship_id,
          x.s_condition_code as code, x.s_start_condition_datetime as started, x.s_end_condition_datetime as ended
        from {{source_condition}} x {_WITH_PERSON} {_WITH_VISIT}
        left join {{o_provider}} pr on pr.provider_source_value = x.k_provider
        left join {{fanout}} t on t.oid = x.s_condition_code_type_oid and t.concept_code = x.s_condition_code
        {hit('ty', 'm_condition_type')} {hit('cs', 's_condition_status')} where {_KEPT}""",
    "m_procedure": f"""select 'source_procedure' as g_source_table_name, x.*, p.person_id, v.visit_occurrence_id,
          pr.provider_id, coalesce(ty.standard_only_id, 0) as type_concept_id,
          coalesce(t.concept_id, 0) as source_concept_id, coalesce(t.mapped_concept_id, 0) as concept_id,
          t.mapped_domain_id, t.domain_id, t.relationship_id,
          x.s_procedure_code as code, x.s_start_procedure_datetime as started, x.s_end_procedure_datetime as ended
        from {{source_procedure}} x {_WITH_PERSON} {_WITH_VISIT}
        left join {{o_provider}} pr on pr.provider_source_value = x.k_provider
        left join {{fanout}} t on t.oid = x.s_procedure_code_type_oid and t.concept_code = x.s_procedure_code
        {hit('ty', 'm_procedure_type')} where {_KEPT}""",
    "m_device": f"""select 'source_device' as g_source_table_name, x.*, p.person_id, v.visit_occurrence_id,
          coalesce(ty.standard_only_id, 0) as type_concept_id,
          {winner('concept_id', 'd1', 'd2')} as source_concept_id,
          {winner('mapped_concept_id', 'd1', 'd2')} as concept_id, {winner_domain('d1', 'd2')} as mapped_domain_id,
          x.s_device_code as code, x.s_start_device_datetime as started, x.s_end_device_datetime as ended
        from {{source_device}} x {_WITH_PERSON} {_WITH_VISIT}
        {hit('d1', 'm_device')} {hit('d2', 's_device')} {hit('ty', 'm_device_type')} where {_KEPT}""",
    "m_medication": f"""select 'source_medication' as g_source_table_name, x.*, p.person_id, v.visit_occurrence_id,
          pr.provider_id,
          case when coalesce(t1.standard_only_id, 0) > 0 then t1.standard_only_id
            else coalesce(t2.standard_only_id, 0) end as type_concept_id,
          {in_domain('Route', 'ro')} as route_concept_id,
          {winner('concept_id', 'd1', 'd2', 'd3')} as source_concept_id,
          {in_domain('Drug', 'd1', 'd2', 'd3')} as concept_id, {winner_domain('d1', 'd2', 'd3')} as mapped_domain_id,
          coalesce(x.s_drug_code, x.m_drug_code, x.g_drug_code, '') || '|' ||
            coalesce(x.s_drug_text, x.g_drug_text, '') as code,
          x.s_start_medication_datetime as started, x.s_end_medication_datetime as ended
        from {{source_medication}} x {_WITH_PERSON} {_WITH_VISIT}
        left join {{o_provider}} pr on pr.provider_source_value = x.k_provider
        {hit('d1', 'm_drug')} {hit('d2', 's_drug')} {hit('d3', 'g_drug')} {hit('ro', 's_route')}
        {hit('t1', 'm_drug_type')} {hit('t2', 's_drug_type')} where {_KEPT}""",
    "m_result": f"""select 'source_result' as g_source_table_name, x.*, p.person_id, v.visit_occurrence_id,
          coalesce(ty.standard_only_id, 0) as type_concept_id,
          {winner('concept_id', 'd1', 'd2')} as source_concept_id,
          {winner('mapped_concept_id', 'd1', 'd2')} as concept_id, {winner_domain('d1', 'd2')} as mapped_domain_id,
          {in_domain('Unit', 'un')} as unit_concept_id, {winner('mapped_concept_id', 're')} as value_as_concept_id,
          coalesce(x.m_code, x.s_code) as code, x.s_obtained_datetime as started, cast(null as varchar) as ended
        from {{source_result}} x {_WITH_PERSON} {_WITH_VISIT}
        {hit('d1', 'm')} {hit('d2', 's')} {hit('un', 's_result_unit')} {hit('re', 's_result')}
        {hit('ty', 'm_source')} where {_KEPT}""",
    "o_note": f"""select p.person_id, v.visit_occurrence_id, x.s_id, {day('substr(x.s_note_datetime, 1, 10)')} as note_date,
          {moment('x.s_note_datetime')} as note_datetime,
          coalesce(cl.standard_only_id, 0) as note_class_concept_id,
          coalesce(la.standard_only_id, 0) as language_concept_id,
          coalesce(ty.standard_only_id, 0) as note_type_concept_id, 0 as encoding_concept_id,
          x.s_note_class as note_source_value, x.s_note_title as note_title, x.s_note_text as note_text
        from {{source_note}} x {_WITH_PERSON} {_WITH_VISIT}
        {hit('cl', 'm_note_class')} {hit('la', 's_language')} {hit('ty', 's_note_type')} where {_KEPT}""",
}

# Which matched sources feed a combined table, and by which rule.
_ROUTES = {
    "condition_occurrence": ("Condition", ("m_condition",)),
    "procedure_occurrence": ("Procedure", ("m_condition", "m_procedure")),
    "drug_exposure": ("Drug", ("m_procedure", "m_medication")),
    "device_exposure": ("Device", ("m_procedure", "m_device")),
    "measurement": ("Measurement", ("m_condition", "m_procedure", "m_result")),
    "observation": ("Observation", ("m_condition", "m_procedure", "m_result")),
}


def routed(domain: str, source: str) -> str:
    """Filter of the rows of one matched source that belong to a domain."""
    if source == "m_medication":
        return "(m.mapped_domain_id is null or m.mapped_domain_id = 'Drug')"
    unmapped = " or (m.mapped_domain_id is null and m.domain_id = '%s')" % domain
    keeps = source in ("m_condition", "m_procedure")
    return f"(m.mapped_domain_id = '{domain}'{unmapped if keeps else ''})"


def combined(table: str, extra: dict[str, dict[str, str]] | None = None) -> str:
    """The common columns of a combined table; ``extra`` adds columns per source."""
    domain, sources = _ROUTES[table]
    names = list(dict.fromkeys(c for cols in (extra or {}).values() for c in cols))
    parts = []
    for source in sources:
        # Without a dot a column is null in the sources that do not provide it.
        more = "".join(f", {(extra or {}).get(source, {}).get(c, 'null')} as {c}" for c in names)
        parts.append(
            f"select m.person_id, m.visit_occurrence_id, m.concept_id, m.source_concept_id, m.code, "
            f"m.type_concept_id, {day('substr(m.started, 1, 10)')} as start_date, m.g_source_table_name, "
            f"m.s_id, m.started, m.ended{more} from {{{source}}} m where {routed(domain, source)}"
        )
    return " union all ".join(parts)


ORACLE_VIEWS |= {
    "o_condition_occurrence": combined("condition_occurrence", {"m_condition": {
        "provider_id": "m.provider_id", "condition_status_concept_id": "m.condition_status_concept_id",
        "condition_status_source_value": "m.s_condition_status"}}),
    "o_procedure_occurrence": combined("procedure_occurrence", {"m_procedure": {"provider_id": "m.provider_id"}}),
    "o_drug_exposure": combined("drug_exposure", {"m_medication": {
        "provider_id": "m.provider_id", "route_concept_id": "m.route_concept_id",
        "route_source_value": "m.s_route", "stop_reason": "m.s_status",
        "quantity": "cast(m.s_quantity as double)", "dose_unit_source_value": "m.s_dose_unit"}}),
    "o_device_exposure": combined("device_exposure", {"m_device": {"unique_device_id": "m.s_unique_device_identifier"}}),
    "o_measurement": combined("measurement", {"m_result": {
        "value_as_number": "try_cast(m.s_result_numeric as double)", "unit_concept_id": "m.unit_concept_id",
        "value_as_concept_id": "m.value_as_concept_id",
        "value_source_value": "coalesce(m.m_result_text, m.s_result_text)", "unit_source_value": "m.s_result_unit",
        "range_low": "cast(m.s_result_numeric_lower as double)",
        "range_high": "cast(m.s_result_numeric_upper as double)"}}),
    "o_observation": combined("observation", {"m_result": {
        "value_as_number": "try_cast(m.s_result_numeric as double)", "unit_concept_id": "m.unit_concept_id",
        "value_as_concept_id": "m.value_as_concept_id",
        "value_as_string": "coalesce(m.m_result_text, m.s_result_text)", "unit_source_value": "m.s_result_unit"}}),
    "o_fact_relationship": """select 3000002 as domain_concept_id_1, p.payer_plan_period_id as fact_id_1,
          3000001 as domain_concept_id_2, v.visit_occurrence_id as fact_id_2, 3000003 as relationship_concept_id
        from {source_relationship} r join {o_payer} p on p.s_id = r.s_target_from_value
        join {o_link} v on v.s_encounter_id = r.s_target_to_value""",
}


def oracle_text(sql: str) -> str:
    """A template as one statement, its views as common table expressions."""
    needed: dict[str, str] = {}

    def collect(text: str) -> None:
        for name in dependencies(text):
            if name in BASE_TABLES or name in needed:
                continue
            source = ORACLE_VIEWS.get(name) or VIEWS[name]
            collect(source)
            needed[name] = source

    collect(sql)
    names = {n: n for n in [*needed, *BASE_TABLES]}
    clauses = ", ".join(f"{n} as ({body.format(**names)})" for n, body in needed.items())
    return (f"with {clauses} " if clauses else "") + sql.format(**names)
