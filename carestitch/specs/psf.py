"""Layouts of the untyped staging tables ("source_*"): the columns of each table in their order, all strings."""

from __future__ import annotations

from .table import TableSpec

# Column names of the staging layout.
LAYOUTS = {
    "source_person": """
        s_person_id, s_gender, s_gender_code, s_gender_code_type, s_gender_code_type_oid, m_gender,
        m_gender_code, m_gender_code_type, m_gender_code_type_oid, s_birth_datetime, s_death_datetime,
        m_death_source, m_death_source_code, m_death_source_code_type, m_death_source_code_type_oid, s_race,
        s_race_code, s_race_code_type, s_race_code_type_oid, m_race, m_race_code, m_race_code_type,
        m_race_code_type_oid, s_ethnicity, s_ethnicity_code, s_ethnicity_code_type, s_ethnicity_code_type_oid,
        m_ethnicity, m_ethnicity_code, m_ethnicity_code_type, m_ethnicity_code_type_oid, k_location, i_exclude,
        s_id, s_source_system, m_source_system
    """,
    "source_person_address_history": """
        s_person_id, s_start_datetime, s_end_datetime, k_location, s_address_type, s_address_type_code,
        s_address_type_code_type, s_address_type_code_type_oid, s_source_system, m_source_system
    """,
    "source_person_map": """
        s_person_id, s_map_name, s_source_system, s_sequence_id, s_alternative_id
    """,
    "source_observation_period": """
        s_person_id, s_start_observation_datetime, s_end_observation_datetime, m_source, m_source_code,
        m_source_code_type, m_source_code_type_oid
    """,
    "source_encounter": """
        s_encounter_id, s_person_id, s_visit_start_datetime, s_visit_end_datetime, s_visit_type,
        s_visit_type_code, s_visit_type_code_type, s_visit_type_code_type_oid, m_visit_type, m_visit_type_code,
        m_visit_type_code_type, m_visit_type_code_type_oid, m_visit_source, m_visit_source_code,
        m_visit_source_code_type, m_visit_source_code_type_oid, s_discharge_to, s_discharge_to_code,
        s_discharge_to_code_type, s_discharge_to_code_type_oid, m_discharge_to, m_discharge_to_code,
        m_discharge_to_code_type, m_discharge_to_code_type_oid, s_admitting_source, s_admitting_source_code,
        s_admitting_source_code_type, s_admitting_source_code_type_oid, m_admitting_source,
        m_admitting_source_code, m_admitting_source_code_type, m_admitting_source_code_type_oid, k_care_site,
        k_provider, i_exclude, s_id, s_source_system, m_source_system
    """,
    "source_encounter_map": """
        s_encounter_id, s_map_name, s_source_system, s_sequence_id, s_alternative_id
    """,
    "source_encounter_detail": """
        s_encounter_detail_id, s_person_id, s_encounter_id, s_start_datetime, s_end_datetime, k_care_site,
        s_visit_detail_type, s_visit_detail_type_code, s_visit_detail_type_code_type,
        s_visit_detail_type_code_type_oid, m_visit_detail_type, m_visit_detail_type_code,
        m_visit_detail_type_code_type, m_visit_detail_type_code_type_oid, m_visit_detail_source,
        m_visit_detail_source_code, m_visit_detail_source_code_type, m_visit_detail_source_code_type_oid,
        k_provider, i_exclude, s_id, s_source_system, m_source_system
    """,
    "source_condition": """
        s_person_id, s_encounter_id, s_start_condition_datetime, s_end_condition_datetime, s_condition_code,
        s_condition_code_type, s_condition_code_type_oid, m_condition_type, m_condition_type_code,
        m_condition_type_code_type, m_condition_type_code_type_oid, s_condition_status, s_condition_status_code,
        s_condition_status_code_type, s_condition_status_code_type_oid, m_condition_status,
        m_condition_status_code, m_condition_status_code_type, m_condition_status_code_type_oid,
        s_present_on_admission_indicator, s_sequence_id, k_provider, i_exclude, s_id, s_source_system,
        m_source_system
    """,
    "source_procedure": """
        s_person_id, s_encounter_id, s_start_procedure_datetime, s_end_procedure_datetime, s_procedure_code,
        s_procedure_code_type, s_procedure_code_type_oid, m_procedure_type, m_procedure_type_code,
        m_procedure_type_code_type, m_procedure_type_code_type_oid, s_sequence_id, s_modifier, s_modifier_code,
        s_modifier_code_type, s_modifier_code_type_oid, s_quantity, k_provider, i_exclude, s_id,
        s_place_of_service_code, s_place_of_service_code_type, s_place_of_service_code_type_oid,
        s_source_system, m_source_system
    """,
    "source_device": """
        s_id, s_person_id, s_encounter_id, s_start_device_datetime, s_end_device_datetime, s_device,
        s_device_code, s_device_code_type, s_device_code_type_oid, m_device, m_device_code, m_device_code_type,
        m_device_code_type_oid, s_unique_device_identifier, m_device_type, m_device_type_code,
        m_device_type_code_type, m_device_type_code_type_oid, k_provider, i_exclude, s_source_system,
        m_source_system
    """,
    "source_result": """
        s_person_id, s_encounter_id, s_obtained_datetime, s_name, s_code, s_code_type, s_code_type_oid, m_code,
        m_code_type, m_code_type_oid, s_result_text, m_result_text, s_result_numeric, m_result_numeric,
        s_result_datetime, s_result_code, s_result_code_type, s_result_code_type_oid, m_result_code,
        m_result_code_type, m_result_code_type_oid, s_result_unit, s_result_unit_code, s_result_unit_code_type,
        s_result_unit_code_type_oid, m_result_unit, m_result_unit_code, m_result_unit_code_type,
        m_result_unit_code_type_oid, s_result_numeric_lower, s_result_numeric_upper, m_result_numeric_lower,
        m_result_numeric_upper, s_operator, m_operator, m_operator_code, m_operator_code_type,
        m_operator_code_type_oid, s_source, m_source, m_source_code, m_source_code_type, m_source_code_type_oid,
        i_exclude, s_id, k_provider, s_source_system, m_source_system
    """,
    "source_medication": """
        s_person_id, s_encounter_id, s_drug_code, s_drug_code_type, s_drug_code_type_oid, m_drug_code,
        m_drug_code_type, m_drug_code_type_oid, s_drug_text, m_drug_text, g_drug_text, g_drug_code,
        g_drug_code_type, g_drug_code_type_oid, s_drug_alternative_text, s_start_medication_datetime,
        s_end_medication_datetime, s_route, s_route_code, s_route_code_type, s_route_code_type_oid, m_route,
        m_route_code, m_route_code_type, m_route_code_type_oid, s_quantity, s_dose, m_dose, s_dose_unit,
        s_dose_unit_code, s_dose_unit_code_type, s_dose_unit_code_type_oid, m_dose_unit, m_dose_unit_code,
        m_dose_unit_code_type, m_dose_unit_code_type_oid, s_status, s_drug_type, s_drug_type_code,
        s_drug_type_code_type, s_drug_type_code_type_oid, m_drug_type, m_drug_type_code, m_drug_type_code_type,
        m_drug_type_code_type_oid, k_provider, i_exclude, s_id, s_source_system, m_source_system
    """,
    "source_care_site": """
        k_care_site, s_care_site_name, k_location
    """,
    "source_provider": """
        k_provider, s_provider_name, s_npi, s_dea_number, s_specialty, s_specialty_code, s_specialty_code_type,
        s_specialty_code_type_oid, m_specialty, m_specialty_code, m_specialty_code_type,
        m_specialty_code_type_oid, s_birth_datetime, s_gender, s_gender_code, s_gender_code_type,
        s_gender_code_type_oid, m_gender, m_gender_code, m_gender_code_type, m_gender_code_type_oid,
        k_care_site, s_source_system, m_source_system, i_exclude
    """,
    "source_provider_map": """
        k_provider, s_map_name, s_source_system, s_sequence_id, s_alternative_id
    """,
    "source_provider_specialty": """
        k_provider, s_sequence_id, s_specialty, s_specialty_code, s_specialty_code_type,
        s_specialty_code_type_oid, s_source_system, m_source_system
    """,
    "source_location": """
        k_location, s_address_1, s_address_2, s_city, s_state, s_zip, s_county, s_country, s_location_name,
        s_latitude, s_longitude, s_geocoding_type
    """,
    "source_payer": """
        s_person_id, s_payer_start_datetime, s_payer_end_datetime, s_payer, s_payer_code, s_payer_code_type,
        s_payer_code_type_oid, m_payer, m_payer_code, m_payer_code_type, m_payer_code_type_oid, s_plan,
        s_plan_code, s_plan_code_type, s_plan_code_type_oid, m_plan, m_plan_code, m_plan_code_type,
        m_plan_code_type_oid, s_contributor, s_source_system, m_source_system, i_exclude
    """,
    "source_note": """
        s_id, s_person_id, s_encounter_id, s_note_datetime, s_note_text, s_note_title, s_note_class,
        s_note_class_code, s_note_class_code_type, s_note_class_code_type_oid, m_note_class, m_note_class_code,
        m_note_class_code_type, m_note_class_code_type_oid, k_provider, s_note_type, s_note_type_code,
        s_note_type_code_type, s_note_type_code_type_oid, s_language, s_language_code, s_language_code_type,
        s_language_code_type_oid, s_encoding, s_encoding_code, s_encoding_code_type, s_encoding_code_type_oid,
        i_exclude
    """,
    "source_relationship": """
        s_id, s_relationship, s_relationship_code, s_relationship_code_type, s_relationship_code_type_oid,
        s_target_from_table_name, s_target_from_table_field, s_target_from_value, s_target_to_table_name,
        s_target_to_table_field, s_target_to_value
    """,
}

PSF_SPECS = {
    table: TableSpec(table, {name.strip(): "string" for name in names.split(",")})
    for table, names in LAYOUTS.items()
}

# Tables the CDM mapper reads; the others are layouts only.
STAGED_TABLES = tuple(
    name for name in PSF_SPECS
    if name not in {
        "source_person_address_history", "source_provider_map",
        "source_provider_specialty", "source_relationship",
    }
)


def psf_spec(name: str) -> TableSpec:
    return PSF_SPECS[name]
