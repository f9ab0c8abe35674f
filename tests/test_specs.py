import pytest

from carestitch.specs import PSF_SPECS, STAGED_TABLES, cdm_spec, cdm_specs


@pytest.mark.parametrize("table, columns", [
    ("source_person", 36), ("source_observation_period", 7), ("source_encounter", 38),
    ("source_encounter_detail", 23), ("source_condition", 26), ("source_procedure", 25),
    ("source_device", 22), ("source_result", 48), ("source_medication", 50), ("source_care_site", 3),
    ("source_provider", 25), ("source_location", 12), ("source_payer", 23), ("source_note", 28),
    ("source_relationship", 11), ("source_person_address_history", 10), ("source_provider_specialty", 8),
])
def test_staging_layouts_have_their_columns(table, columns):
    assert len(PSF_SPECS[table].columns) == columns


@pytest.mark.parametrize("version, table, columns", [
    ("5.4", "person", "person_id gender_concept_id year_of_birth month_of_birth day_of_birth birth_datetime race_concept_id"),
    ("5.4", "condition_occurrence", "condition_occurrence_id person_id condition_concept_id condition_start_date"),
    ("5.4", "visit_occurrence", "visit_occurrence_id person_id visit_concept_id visit_start_date visit_start_datetime"),
    ("5.4", "visit_detail", "visit_detail_id person_id visit_detail_concept_id visit_detail_start_date"),
    ("5.4", "drug_exposure", "drug_exposure_id person_id drug_concept_id drug_exposure_start_date"),
    ("5.4", "device_exposure", "device_exposure_id person_id device_concept_id device_exposure_start_date"),
    ("5.4", "procedure_occurrence", "procedure_occurrence_id person_id procedure_concept_id procedure_date"),
    ("5.4", "measurement", "measurement_id person_id measurement_concept_id measurement_date"),
    ("5.4", "observation", "observation_id person_id observation_concept_id observation_date"),
    ("5.4", "provider", "provider_id provider_name npi dea specialty_concept_id care_site_id year_of_birth gender_concept_id"),
    ("5.4", "episode", "episode_id person_id episode_concept_id episode_start_date"),
    ("5.3.1", "person", "person_id gender_concept_id year_of_birth"),
    ("5.3.1", "visit_occurrence", "visit_occurrence_id person_id visit_concept_id visit_start_date"),
    ("5.3.1", "provider", "provider_id provider_name npi dea specialty_concept_id"),
])
def test_columns_stand_in_their_order(version, table, columns):
    assert list(cdm_specs(version)[table].columns)[:len(columns.split())] == columns.split()


def test_eras_of_the_older_version_are_timestamps():
    for table in ("condition_era", "drug_era", "dose_era"):
        kinds = {n: k for n, k in cdm_specs("5.3.1")[table].columns.items() if n.endswith("_date")}
        assert set(kinds.values()) == {"timestamp"} and len(kinds) == 2, kinds


def test_staging_layouts():
    assert len(PSF_SPECS) == 20 and len(STAGED_TABLES) == 16
    assert list(PSF_SPECS["source_provider"].columns)[3:5] == ["s_dea_number", "s_specialty"]
    assert set(PSF_SPECS["source_result"].columns) >= {"s_code_type_oid", "m_result_code", "s_result_unit"}
    assert "s_result" not in PSF_SPECS["source_result"].columns


def test_cdm_versions():
    new, old = cdm_specs("5.4"), cdm_specs("5.3.1")
    assert (len(new), len(old)) == (39, 37)
    assert cdm_specs("5.4.1") == new
    assert "attribute_definition" in old and "episode" not in old
    assert "admitting_source_concept_id" in old["visit_occurrence"].columns
    assert "admitted_from_concept_id" in new["visit_occurrence"].columns
    assert "visit_detail_parent_id" in old["visit_detail"].columns
    assert "production_id" not in old["device_exposure"].columns
    with pytest.raises(ValueError):
        cdm_specs("6.0")


@pytest.mark.parametrize("table, column, kind", [
    ("person", "person_id", "bigint"), ("person", "year_of_birth", "int"),
    ("person", "birth_datetime", "timestamp"), ("death", "death_date", "date"),
    ("measurement", "value_as_number", "double"), ("drug_exposure", "quantity", "double"),
    ("device_exposure", "quantity", "int"), ("concept", "vocabulary_id", "string"),
    ("concept_class", "concept_class_concept_id", "int"), ("cost", "total_paid", "double"),
    ("fact_relationship", "fact_id_2", "bigint"), ("note", "note_text", "string"),
])
def test_column_types(table, column, kind):
    assert cdm_specs("5.4")[table].columns[column] == kind


def test_lineage_columns_and_empty_tables(spark):
    spec = cdm_spec("condition_occurrence")
    assert list(spec.columns)[-3:] == ["s_id", "g_source_table_name", "s_g_id"]
    empty = spec.empty(spark)
    assert empty.count() == 0 and empty.columns == list(spec.columns)
    assert "g_id" in PSF_SPECS["source_note"].empty(spark, g_id="bigint").columns
