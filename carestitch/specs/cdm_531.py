"""Layouts of the common data model, version 5.3.1: the columns of each table in their order, as Spark DDL."""

# Column names, order and types of the public CDM 5.3.1 standard.
LAYOUTS = {
    "attribute_definition": """
        attribute_definition_id bigint, attribute_name string, attribute_description string,
        attribute_type_concept_id int, attribute_syntax string
    """,
    "care_site": """
        care_site_id bigint, care_site_name string, place_of_service_concept_id int, location_id bigint,
        care_site_source_value string, place_of_service_source_value string
    """,
    "cdm_source": """
        cdm_source_name string, cdm_source_abbreviation string, cdm_holder string, source_description string,
        source_documentation_reference string, cdm_etl_reference string, source_release_date date,
        cdm_release_date date, cdm_version string, vocabulary_version string
    """,
    "cohort_definition": """
        cohort_definition_id bigint, cohort_definition_name string, cohort_definition_description string,
        definition_type_concept_id int, cohort_definition_syntax string, subject_concept_id int,
        cohort_initiation_date date
    """,
    "concept": """
        concept_id int, concept_name string, domain_id string, vocabulary_id string, concept_class_id string,
        standard_concept string, concept_code string, valid_start_date date, valid_end_date date,
        invalid_reason string
    """,
    "concept_ancestor": """
        ancestor_concept_id int, descendant_concept_id int, min_levels_of_separation int,
        max_levels_of_separation int
    """,
    "concept_class": """
        concept_class_id string, concept_class_name string, concept_class_concept_id int
    """,
    "concept_relationship": """
        concept_id_1 int, concept_id_2 int, relationship_id string, valid_start_date date, valid_end_date date,
        invalid_reason string
    """,
    "concept_synonym": """
        concept_id int, concept_synonym_name string, language_concept_id int
    """,
    "condition_era": """
        condition_era_id bigint, person_id bigint, condition_concept_id int, condition_era_start_date timestamp,
        condition_era_end_date timestamp, condition_occurrence_count int
    """,
    "condition_occurrence": """
        condition_occurrence_id bigint, person_id bigint, condition_concept_id int, condition_start_date date,
        condition_start_datetime timestamp, condition_end_date date, condition_end_datetime timestamp,
        condition_type_concept_id int, condition_status_concept_id int, stop_reason string, provider_id bigint,
        visit_occurrence_id bigint, visit_detail_id bigint, condition_source_value string,
        condition_source_concept_id int, condition_status_source_value string
    """,
    "cost": """
        cost_id bigint, cost_event_id bigint, cost_domain_id string, cost_type_concept_id int,
        currency_concept_id int, total_charge double, total_cost double, total_paid double,
        paid_by_payer double, paid_by_patient double, paid_patient_copay double,
        paid_patient_coinsurance double, paid_patient_deductible double, paid_by_primary double,
        paid_ingredient_cost double, paid_dispensing_fee double, payer_plan_period_id bigint,
        amount_allowed double, revenue_code_concept_id int, revenue_code_source_value string,
        drg_concept_id int, drg_source_value string
    """,
    "death": """
        person_id bigint, death_date date, death_datetime timestamp, death_type_concept_id int,
        cause_concept_id int, cause_source_value string, cause_source_concept_id int
    """,
    "device_exposure": """
        device_exposure_id bigint, person_id bigint, device_concept_id int, device_exposure_start_date date,
        device_exposure_start_datetime timestamp, device_exposure_end_date date,
        device_exposure_end_datetime timestamp, device_type_concept_id int, unique_device_id string,
        quantity int, provider_id bigint, visit_occurrence_id bigint, visit_detail_id bigint,
        device_source_value string, device_source_concept_id int
    """,
    "domain": """
        domain_id string, domain_name string, domain_concept_id int
    """,
    "dose_era": """
        dose_era_id bigint, person_id bigint, drug_concept_id int, unit_concept_id int, dose_value double,
        dose_era_start_date timestamp, dose_era_end_date timestamp
    """,
    "drug_era": """
        drug_era_id bigint, person_id bigint, drug_concept_id int, drug_era_start_date timestamp,
        drug_era_end_date timestamp, drug_exposure_count int, gap_days int
    """,
    "drug_exposure": """
        drug_exposure_id bigint, person_id bigint, drug_concept_id int, drug_exposure_start_date date,
        drug_exposure_start_datetime timestamp, drug_exposure_end_date date,
        drug_exposure_end_datetime timestamp, verbatim_end_date date, drug_type_concept_id int,
        stop_reason string, refills int, quantity double, days_supply int, sig string, route_concept_id int,
        lot_number string, provider_id bigint, visit_occurrence_id bigint, visit_detail_id bigint,
        drug_source_value string, drug_source_concept_id int, route_source_value string,
        dose_unit_source_value string
    """,
    "drug_strength": """
        drug_concept_id int, ingredient_concept_id int, amount_value double, amount_unit_concept_id int,
        numerator_value double, numerator_unit_concept_id int, denominator_value double,
        denominator_unit_concept_id int, box_size int, valid_start_date date, valid_end_date date,
        invalid_reason string
    """,
    "fact_relationship": """
        domain_concept_id_1 int, fact_id_1 bigint, domain_concept_id_2 int, fact_id_2 bigint,
        relationship_concept_id int
    """,
    "location": """
        location_id bigint, address_1 string, address_2 string, city string, state string, zip string,
        county string, location_source_value string
    """,
    "measurement": """
        measurement_id bigint, person_id bigint, measurement_concept_id int, measurement_date date,
        measurement_datetime timestamp, measurement_time string, measurement_type_concept_id int,
        operator_concept_id int, value_as_number double, value_as_concept_id int, unit_concept_id int,
        range_low double, range_high double, provider_id bigint, visit_occurrence_id bigint,
        visit_detail_id bigint, measurement_source_value string, measurement_source_concept_id int,
        unit_source_value string, value_source_value string
    """,
    "metadata": """
        metadata_concept_id int, metadata_type_concept_id int, name string, value_as_string string,
        value_as_concept_id int, metadata_date date, metadata_datetime timestamp
    """,
    "note": """
        note_id bigint, person_id bigint, note_date date, note_datetime timestamp, note_type_concept_id int,
        note_class_concept_id int, note_title string, note_text string, encoding_concept_id int,
        language_concept_id int, provider_id bigint, visit_occurrence_id bigint, visit_detail_id bigint,
        note_source_value string
    """,
    "note_nlp": """
        note_nlp_id bigint, note_id bigint, section_concept_id int, snippet string, offset string,
        lexical_variant string, note_nlp_concept_id int, note_nlp_source_concept_id int, nlp_system string,
        nlp_date date, nlp_datetime timestamp, term_exists string, term_temporal string, term_modifiers string
    """,
    "observation": """
        observation_id bigint, person_id bigint, observation_concept_id int, observation_date date,
        observation_datetime timestamp, observation_type_concept_id int, value_as_number double,
        value_as_string string, value_as_concept_id int, qualifier_concept_id int, unit_concept_id int,
        provider_id bigint, visit_occurrence_id bigint, visit_detail_id bigint, observation_source_value string,
        observation_source_concept_id int, unit_source_value string, qualifier_source_value string
    """,
    "observation_period": """
        observation_period_id bigint, person_id bigint, observation_period_start_date date,
        observation_period_end_date date, period_type_concept_id int
    """,
    "payer_plan_period": """
        payer_plan_period_id bigint, person_id bigint, payer_plan_period_start_date date,
        payer_plan_period_end_date date, payer_concept_id int, payer_source_value string,
        payer_source_concept_id int, plan_concept_id int, plan_source_value string, plan_source_concept_id int,
        sponsor_concept_id int, sponsor_source_value string, sponsor_source_concept_id int,
        family_source_value string, stop_reason_concept_id int, stop_reason_source_value string,
        stop_reason_source_concept_id int
    """,
    "person": """
        person_id bigint, gender_concept_id int, year_of_birth int, month_of_birth int, day_of_birth int,
        birth_datetime timestamp, race_concept_id int, ethnicity_concept_id int, location_id bigint,
        provider_id bigint, care_site_id bigint, person_source_value string, gender_source_value string,
        gender_source_concept_id int, race_source_value string, race_source_concept_id int,
        ethnicity_source_value string, ethnicity_source_concept_id int
    """,
    "procedure_occurrence": """
        procedure_occurrence_id bigint, person_id bigint, procedure_concept_id int, procedure_date date,
        procedure_datetime timestamp, procedure_type_concept_id int, modifier_concept_id int, quantity int,
        provider_id bigint, visit_occurrence_id bigint, visit_detail_id bigint, procedure_source_value string,
        procedure_source_concept_id int, modifier_source_value string
    """,
    "provider": """
        provider_id bigint, provider_name string, npi string, dea string, specialty_concept_id int,
        care_site_id bigint, year_of_birth int, gender_concept_id int, provider_source_value string,
        specialty_source_value string, specialty_source_concept_id int, gender_source_value string,
        gender_source_concept_id int
    """,
    "relationship": """
        relationship_id string, relationship_name string, is_hierarchical string, defines_ancestry string,
        reverse_relationship_id string, relationship_concept_id int
    """,
    "source_to_concept_map": """
        source_code string, source_concept_id int, source_vocabulary_id string, source_code_description string,
        target_concept_id int, target_vocabulary_id string, valid_start_date date, valid_end_date date,
        invalid_reason string
    """,
    "specimen": """
        specimen_id bigint, person_id bigint, specimen_concept_id int, specimen_type_concept_id int,
        specimen_date date, specimen_datetime timestamp, quantity double, unit_concept_id int,
        anatomic_site_concept_id int, disease_status_concept_id int, specimen_source_id string,
        specimen_source_value string, unit_source_value string, anatomic_site_source_value string,
        disease_status_source_value string
    """,
    "visit_detail": """
        visit_detail_id bigint, person_id bigint, visit_detail_concept_id int, visit_detail_start_date date,
        visit_detail_start_datetime timestamp, visit_detail_end_date date, visit_detail_end_datetime timestamp,
        visit_detail_type_concept_id int, provider_id bigint, care_site_id bigint,
        visit_detail_source_value string, visit_detail_source_concept_id int, admitting_source_value string,
        admitting_source_concept_id int, discharge_to_source_value string, discharge_to_concept_id int,
        preceding_visit_detail_id bigint, visit_detail_parent_id bigint, visit_occurrence_id bigint
    """,
    "visit_occurrence": """
        visit_occurrence_id bigint, person_id bigint, visit_concept_id int, visit_start_date date,
        visit_start_datetime timestamp, visit_end_date date, visit_end_datetime timestamp,
        visit_type_concept_id int, provider_id bigint, care_site_id bigint, visit_source_value string,
        visit_source_concept_id int, admitting_source_concept_id int, admitting_source_value string,
        discharge_to_concept_id int, discharge_to_source_value string, preceding_visit_occurrence_id bigint
    """,
    "vocabulary": """
        vocabulary_id string, vocabulary_name string, vocabulary_reference string, vocabulary_version string,
        vocabulary_concept_id int
    """,
}
