"""Checks of the synthetic-EHR staging jobs, on extract tables derived from the given ones."""

from __future__ import annotations

from ..operators.project import union_by_name
from ..sources import ehr_csv
from ..specs import PSF_SPECS
from .registry import ORACLES, check, portable
from .views import Bridge

# The extract's tables as views; persons are customers, organizations suppliers.
EXTRACT = {
    "patients": """select 'C' || cast(c_custkey as string) as id,
        case when c_mktsegment = 'BUILDING' then 'F' when c_mktsegment = 'MACHINERY' then 'M' else 'X' end as gender,
        '19' || cast(50 + n_nationkey as string) || '-02-03' as birthdate,
        case when c_acctbal > 9000 then '2002-03-04' end as deathdate,
        case when n_regionkey = 0 then 'black' when n_regionkey = 2 then 'asian' when n_regionkey = 3 then 'white'
          else 'other' end as race,
        case when n_regionkey = 1 then 'hispanic' else 'nonhispanic' end as ethnicity,
        n_name as address, r_name as city, case when n_regionkey <> 4 then 'S' end as state,
        cast(n_nationkey as string) as zip, r_name as county, '1.5' as lat, '-2.5' as lon
        from {customer} join {nation} on n_nationkey = c_nationkey join {region} on r_regionkey = n_regionkey""",
    "organizations": """select 'ORG' || cast(s_suppkey as string) as id, s_name as name, n_name as address,
        r_name as city, case when n_regionkey <> 4 then 'S' end as state, cast(n_nationkey as string) as zip,
        '1.5' as lat, '-2.5' as lon
        from {supplier} join {nation} on n_nationkey = s_nationkey join {region} on r_regionkey = n_regionkey""",
    "providers": """select 'PR' || cast(s_suppkey as string) as id, s_name as name,
        case when s_acctbal > 5000 then 'GENERAL PRACTICE' else 'OTHER' end as speciality,
        case when s_nationkey < 12 then 'F' else 'U' end as gender, 'ORG' || cast(s_suppkey as string) as organization
        from {supplier}""",
    "encounters": """select 'O' || cast(o_orderkey as string) as id, 'C' || cast(o_custkey as string) as patient,
        cast(o_orderdate as string) as start,
        case when o_orderstatus <> 'O' then cast(o_orderdate + interval 1 day as string) end as stop,
        case o_orderpriority when '1-URGENT' then 'emergency' when '2-HIGH' then 'inpatient'
          when '3-MEDIUM' then 'wellness' else 'unknown' end as encounterclass,
        'ORG1' as organization, 'PR1' as provider,
        case when o_orderstatus = 'F' then cast(o_custkey as string) end as reasoncode from {orders}""",
    "payers": """select 'PAY' || cast(n_nationkey as string) as id,
        case when n_regionkey = 0 then 'Aetna' when n_regionkey = 1 then 'Medicare' when n_regionkey = 2 then 'NO_INSURANCE'
          else n_name end as name from {nation}""",
    "payer_transitions": """select 'C' || cast(o_custkey as string) as patient, cast(min(o_orderdate) as string) as start_date,
        case when max(o_orderpriority) <> '5-LOW' then cast(max(o_orderdate) as string) end as end_date,
        'PAY' || cast(min(c_nationkey) as string) as payer
        from {orders} join {customer} on c_custkey = o_custkey group by o_custkey, extract(year from o_orderdate)""",
    "events_of_care": """select 'C' || cast(o_custkey as string) as patient, 'O' || cast(l_orderkey as string) as encounter,
        cast(l_shipdate as string) as start,
        case when l_returnflag = 'A' then cast(l_shipdate + interval 3 day as string) end as stop,
        cast(l_shipdate as string) as date, cast(l_partkey as string) as code, p_name as description,
        cast(l_suppkey as string) as udi, cast(l_quantity as string) as dispenses,
        case when l_returnflag = 'R' then 'numeric' else 'text' end as type,
        case when l_returnflag = 'R' then cast(l_quantity as string)
          when l_linestatus = 'F' then 'Positive (qualifier value)' else p_name end as value,
        l_linestatus as units
        from {lineitem} join {orders} on o_orderkey = l_orderkey join {part} on p_partkey = l_partkey""",
}
_CARE = ("conditions", "procedures", "devices", "medications", "immunizations", "observations")


def extract(b: Bridge):
    frames = {}

    def table(name: str):
        view = "events_of_care" if name in _CARE else name
        if view not in frames:
            frames[view] = b.sql(EXTRACT[view])
        return frames[view]

    return table


def _template(sql: str) -> str:
    """Extract tables written <name> become subqueries."""
    for name, view in {**EXTRACT, **{c: EXTRACT["events_of_care"] for c in _CARE}}.items():
        sql = sql.replace(f"<{name}>", f"({view})")
    return sql


def _staged(name: str, build, columns: str, sql: str) -> None:
    names = columns.split()

    @check(f"ehr_{name}", _template(sql))
    def _(b: Bridge):
        return portable(build(extract(b)).select(*names))


_KEY = "sha1(coalesce(address, '') || coalesce(city, '') || coalesce(state, '') || coalesce(zip, ''))"
_SNOMED = "2.16.840.1.113883.6.96"

_staged("location", ehr_csv.locations, "k_location s_address_1 s_city s_state s_zip s_county s_country s_latitude s_longitude",
        " union ".join(f"select distinct {_KEY} as k_location, address as s_address_1, city as s_city, state as s_state, "
                       f"zip as s_zip, {county} as s_county, 'U.S.A.' as s_country, lat as s_latitude, lon as s_longitude "
                       f"from <{table}>" for table, county in (("patients", "county"), ("organizations", "null"))))
_staged("person", ehr_csv.persons,
        "s_person_id s_gender m_gender m_gender_code m_gender_code_type_oid s_race m_race m_race_code s_ethnicity "
        "m_ethnicity_code s_birth_datetime s_death_datetime k_location s_id s_source_system",
        f"""select id as s_person_id, gender as s_gender, case gender when 'F' then 'Female' when 'M' then 'Male' end as m_gender,
        case when gender in ('F', 'M') then gender end as m_gender_code,
        case when gender in ('F', 'M') then '2.16.840.1.113883.12.1' end as m_gender_code_type_oid, race as s_race,
        case race when 'black' then 'Black' when 'asian' then 'Asian' when 'white' then 'White' end as m_race,
        case race when 'black' then '3.01' when 'asian' then '2' when 'white' then '5' end as m_race_code,
        ethnicity as s_ethnicity, case ethnicity when 'hispanic' then 'Hispanic' else 'Not Hispanic' end as m_ethnicity_code,
        birthdate as s_birth_datetime, deathdate as s_death_datetime, {_KEY} as k_location, id as s_id,
        'synthea' as s_source_system from <patients>""")
_staged("care_site", ehr_csv.care_sites, "k_care_site s_care_site_name k_location",
        f"select distinct id as k_care_site, name as s_care_site_name, {_KEY} as k_location from <organizations>")
_staged("provider", ehr_csv.providers,
        "k_provider s_provider_name s_specialty m_specialty_code s_gender m_gender k_care_site",
        """select id as k_provider, name as s_provider_name, case when speciality = 'GENERAL PRACTICE' then speciality end
        as s_specialty, case when speciality = 'GENERAL PRACTICE' then '208D00000X' end as m_specialty_code,
        case when gender = 'F' then 'F' end as s_gender, case when gender = 'F' then 'Female' end as m_gender,
        organization as k_care_site from <providers>""")
_staged("encounter", ehr_csv.encounters,
        "s_encounter_id s_person_id s_visit_start_datetime s_visit_end_datetime s_visit_type m_visit_type m_visit_type_code "
        "m_visit_source_code k_care_site k_provider s_id",
        """select id as s_encounter_id, patient as s_person_id, start as s_visit_start_datetime, stop as s_visit_end_datetime,
        encounterclass as s_visit_type, case encounterclass when 'emergency' then 'Emergency Room Visit'
        when 'inpatient' then 'Inpatient Visit' when 'wellness' then 'Outpatient Visit' end as m_visit_type,
        case encounterclass when 'emergency' then 'ER' when 'inpatient' then 'IP' when 'wellness' then 'OP' end
        as m_visit_type_code, 'OMOP4976900' as m_visit_source_code, organization as k_care_site, provider as k_provider,
        id as s_id from <encounters>""")
_staged("observation_period", lambda e: ehr_csv.observation_periods(ehr_csv.encounters(e)),
        "s_person_id s_start_observation_datetime s_end_observation_datetime m_source_code",
        """select patient as s_person_id, min(start) as s_start_observation_datetime,
        max(coalesce(stop, start)) as s_end_observation_datetime, 'OMOP4976890' as m_source_code
        from <encounters> group by patient""")

_PAYER = """select distinct t.patient as s_person_id, t.start_date as s_payer_start_datetime,
        t.end_date as s_payer_end_datetime, p.name as s_payer,
        case p.name when 'Aetna' then '5' when 'Medicare' then '1' when 'NO_INSURANCE' then '81' end as m_payer_code,
        sha1(t.patient || '|' || t.start_date || '|' || coalesce(t.end_date, '') || '|' || t.payer) as s_id
        from <payer_transitions> t join <payers> p on p.id = t.payer
        where p.name in ('Aetna', 'Medicare', 'NO_INSURANCE')"""
_staged("payer", ehr_csv.payers,
        "s_person_id s_payer_start_datetime s_payer_end_datetime s_payer m_payer_code s_id", _PAYER)
_staged("relationship", lambda e: ehr_csv.payer_relationships(ehr_csv.payers(e), ehr_csv.encounters(e)),
        "s_id s_relationship s_relationship_code s_target_from_value s_target_to_value s_target_to_table_field",
        f"""select e.id || '||' || e.id as s_id, 'payer' as s_relationship, '4001000175104' as s_relationship_code,
        p.s_id as s_target_from_value, e.id as s_target_to_value, 's_encounter_id' as s_target_to_table_field
        from <encounters> e join ({_PAYER}) p on p.s_person_id = e.patient
        and coalesce(e.stop, e.start) between p.s_payer_start_datetime and p.s_payer_end_datetime""")
_staged("condition", ehr_csv.conditions,
        "s_person_id s_encounter_id s_start_condition_datetime s_end_condition_datetime s_condition_code "
        "s_condition_code_type_oid m_condition_type_code s_condition_status m_condition_status_code",
        f"""select patient as s_person_id, encounter as s_encounter_id, start as s_start_condition_datetime,
        stop as s_end_condition_datetime, code as s_condition_code, '{_SNOMED}' as s_condition_code_type_oid,
        'OMOP4976890' as m_condition_type_code, null as s_condition_status, null as m_condition_status_code from <conditions>
        union select patient, id, start, stop, reasoncode, '{_SNOMED}', 'OMOP4976890', 'Reason', 'OMOP4976972'
        from <encounters> where reasoncode is not null""")
_staged("procedure", ehr_csv.procedures,
        "s_person_id s_encounter_id s_start_procedure_datetime s_end_procedure_datetime s_procedure_code "
        "s_procedure_code_type m_procedure_type_code",
        """select patient as s_person_id, encounter as s_encounter_id, start as s_start_procedure_datetime,
        stop as s_end_procedure_datetime, code as s_procedure_code, 'SNOMED' as s_procedure_code_type,
        'OMOP4976890' as m_procedure_type_code from <procedures>""")
_staged("device", ehr_csv.devices,
        "s_person_id s_encounter_id s_start_device_datetime s_end_device_datetime s_device s_device_code "
        "s_unique_device_identifier",
        """select patient as s_person_id, encounter as s_encounter_id, start as s_start_device_datetime,
        coalesce(stop, start) as s_end_device_datetime, description as s_device, code as s_device_code,
        udi as s_unique_device_identifier from <devices>""")
_staged("medication", ehr_csv.medications,
        "s_person_id s_encounter_id s_drug_code s_drug_code_type s_drug_code_type_oid s_drug_text "
        "s_start_medication_datetime s_end_medication_datetime s_quantity m_drug_type_code",
        """select patient as s_person_id, encounter as s_encounter_id, code as s_drug_code, 'RxNorm' as s_drug_code_type,
        '2.16.840.1.113883.6.88' as s_drug_code_type_oid, description as s_drug_text, start as s_start_medication_datetime,
        coalesce(stop, start) as s_end_medication_datetime, dispenses as s_quantity, 'OMOP4976890' as m_drug_type_code
        from <medications>
        union select patient, encounter, code, 'CVX', '2.16.840.1.113883.12.292', description, date, date, null,
        'OMOP4976890' from <immunizations>""")
_staged("result", ehr_csv.results,
        "s_person_id s_encounter_id s_obtained_datetime s_name s_code s_result_text s_result_numeric m_result_code "
        "m_result_code_type s_result_unit_code m_source_code",
        """select patient as s_person_id, encounter as s_encounter_id, date as s_obtained_datetime, description as s_name,
        code as s_code, case when type = 'text' then value end as s_result_text,
        case when type = 'numeric' then value end as s_result_numeric,
        case when type = 'text' and value = 'Positive (qualifier value)' then 'LA6576-8' end as m_result_code,
        case when type = 'text' and value = 'Positive (qualifier value)' then 'LOINC' end as m_result_code_type,
        units as s_result_unit_code, 'OMOP4976890' as m_source_code from <observations>""")


@check("ehr_person_row_ids", _template("select count(*) as n_rows, count(*) as n_ids from <patients>"))
def _(b: Bridge):
    from pyspark.sql import functions as F
    staged = ehr_csv.staging_tables(b.spark, extract(b))["source_person"]
    return staged.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("g_id").alias("n_ids"))


_TABLES = ("location", "person", "care_site", "provider", "encounter", "observation_period", "payer", "relationship",
           "condition", "procedure", "device", "medication", "result")


@check("ehr_table_rows", " union all ".join([
    *[f"select 'source_{name}' as staging_table, count(*) as n_rows from ({ORACLES[f'ehr_{name}']})" for name in _TABLES],
    *[f"select '{name}', 0" for name in ehr_csv.EMPTY_TABLES]]))
def _(b: Bridge):
    """Rows of every staging table of an extract; four come without rows but in their layout."""
    from pyspark.sql import functions as F
    staged = ehr_csv.staging_tables(b.spark, extract(b))
    assert all(staged[name].columns == [*PSF_SPECS[name].columns, "g_id"] for name in ehr_csv.EMPTY_TABLES)
    return union_by_name([df.agg(F.lit(name).alias("staging_table"), F.count(F.lit(1)).alias("n_rows")) for name, df in staged.items()])
