"""A synthetic extract through every step: vocabulary, staging, mapping, report, publishing."""

import json
import os

import pytest
from pyspark.sql import functions as F

from carestitch.plans.cdm_source import populate_cdm_source
from carestitch.plans.pipeline import map_to_cdm, run_report, stable_ids, stage_documents
from carestitch.plans.stats import EXTENDED, STANDARD
from carestitch.sinks.parquet import read_manifest
from carestitch.sinks.publish import jdbc_targets, publish_tables
from carestitch.sources.ehr_csv import stage_extract
from carestitch.sources.tabular import StagingConfig, read_lookup, stage_csv
from carestitch.sources.vocabulary import build_vocabulary, load_vocabulary

CONCEPTS = [  # id, name, domain, vocabulary, class, standard, code
    (8507, "MALE", "Gender", "Gender", "Gender", "S", "M"), (8532, "FEMALE", "Gender", "Gender", "Gender", "S", "F"),
    (8516, "Black", "Race", "Race", "Race", "S", "3.01"), (8527, "White", "Race", "Race", "Race", "S", "5"),
    (38003564, "Not Hispanic", "Ethnicity", "Ethnicity", "Ethnicity", "S", "Not Hispanic"),
    (9201, "Inpatient Visit", "Visit", "Visit", "Visit", "S", "IP"),
    (9202, "Outpatient Visit", "Visit", "Visit", "Visit", "S", "OP"),
    (32817, "EHR", "Type Concept", "Type Concept", "Type Concept", "S", "OMOP4976890"),
    (32827, "EHR encounter record", "Type Concept", "Type Concept", "Type Concept", "S", "OMOP4976900"),
    (280, "Medicare", "Payer", "SOPT", "Payer", "S", "1"),
    (201826, "Diabetes", "Condition", "SNOMED", "Finding", "S", "44054006"),
    (4000, "Unmapped finding", "Condition", "SNOMED", "Finding", None, "111"),
    (4163872, "X-ray", "Procedure", "SNOMED", "Procedure", "S", "399208008"),
    (4046263, "Enzyme measurement", "Measurement", "SNOMED", "Procedure", "S", "222"),
    (45548980, "Abnormal enzyme", "Condition", "SNOMED", "Finding", None, "333"),
    (4135493, "Abnormal", "Meas Value", "SNOMED", "Qualifier", "S", "444"),
    (4217646, "Pacemaker", "Device", "SNOMED", "Device", "S", "72506001"),
    (1127433, "Paracetamol", "Drug", "RxNorm", "Clinical Drug", "S", "313782"),
    (40213154, "Influenza vaccine", "Drug", "CVX", "CVX", "S", "140"),
    (3004410, "HbA1c", "Measurement", "LOINC", "Lab Test", "S", "4548-4"),
    (40766240, "Smoking", "Observation", "LOINC", "Survey", "S", "72166-2"),
    (8554, "percent", "Unit", "UCUM", "Unit", "S", "%"),
    (45877985, "Detected", "Meas Value", "LOINC", "Answer", "S", "LA11882-0"),
    (756265, "CDM v5.4.1", "Metadata", "CDM", "CDM", "S", "CDM v5.4.1"),
    (8, "Visit", "Metadata", "Domain", "Domain", "S", "visit"),
    (32577, "Payer - institution administering healthcare transactions", "Metadata", "Domain", "Domain", "S", "payer"),
    (4001, "Payer of", "Observation", "SNOMED", "Link", "S", "4001000175104"),
]
MAPS = [(c[0], c[0], "Maps to") for c in CONCEPTS if c[5] == "S"] + [
    (45548980, 4046263, "Maps to"), (45548980, 4135493, "Maps to value"), (45548980, 201826, "Is a")]

EXTRACT = {
    "patients": """Id,BIRTHDATE,DEATHDATE,GENDER,RACE,ETHNICITY,ADDRESS,CITY,STATE,ZIP,COUNTY,LAT,LON
p1,1950-02-03,2021-05-06,M,white,nonhispanic,"1, Main
St",Town,MA,01234,Kent,1.5,-2.5
p2,1980-07-08,,F,black,nonhispanic,2 Side St,Town,MA,01234,Kent,1.5,-2.5
""",
    "organizations": "Id,NAME,ADDRESS,CITY,STATE,ZIP,LAT,LON\no1,Clinic,9 High St,Town,MA,01234,1.0,2.0\n",
    "providers": "Id,NAME,SPECIALITY,GENDER,ORGANIZATION\nd1,Dr A,GENERAL PRACTICE,F,o1\n",
    "encounters": """Id,START,STOP,PATIENT,ORGANIZATION,PROVIDER,ENCOUNTERCLASS,REASONCODE
e1,2020-01-01T10:00:00Z,2020-01-02T10:00:00Z,p1,o1,d1,inpatient,44054006
e2,2020-03-01T10:00:00Z,,p2,o1,d1,wellness,
""",
    "payers": "Id,NAME\ny1,Medicare\ny2,Unknown payer\n",
    "payer_transitions": "PATIENT,START_DATE,END_DATE,PAYER\np1,2019-12-31T00:00:00Z,2020-12-31T00:00:00Z,y1\np2,2020-01-01T00:00:00Z,2021-01-01T00:00:00Z,y2\n",
    "conditions": """START,STOP,PATIENT,ENCOUNTER,CODE
2020-01-01,2020-01-05,p1,e1,44054006
2020-01-01,,p1,e1,333
2020-01-01,,p2,e2,111
2020-01-01,,nobody,e2,44054006
2020-01-01,,p2,missing,44054006
2020-01-01,,p2,missing,44054006
""",
    "procedures": "START,STOP,PATIENT,ENCOUNTER,CODE\n2020-01-01T11:00:00Z,2020-01-01T12:00:00Z,p1,e1,399208008\n",
    "devices": "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION,UDI\n2020-01-01T11:00:00Z,,p1,e1,72506001,Pacemaker,udi-1\n",
    "medications": "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION,DISPENSES\n2020-01-01T11:00:00Z,,p1,e1,313782,Paracetamol,12\n2020-01-01T11:00:00Z,,p1,e1,000,Mystery,1\n",
    "immunizations": "DATE,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n2020-03-01T10:00:00Z,p2,e2,140,Influenza\n",
    "observations": """DATE,PATIENT,ENCOUNTER,CODE,DESCRIPTION,VALUE,UNITS,TYPE
2020-01-01T11:00:00Z,p1,e1,4548-4,HbA1c,6.5,%,numeric
2020-01-01T11:00:00Z,p1,,72166-2,Smoking,Detected (qualifier value),,text
""",
}


def _files(folder, base):
    concept = "\n".join("\t".join(str(v) if v is not None else "" for v in (*c, 19700101, 20991231, "")) for c in CONCEPTS)
    vocabularies = sorted({c[3] for c in CONCEPTS})
    files = {
        "CONCEPT": "concept_id\tconcept_name\tdomain_id\tvocabulary_id\tconcept_class_id\tstandard_concept\tconcept_code\tvalid_start_date\tvalid_end_date\tinvalid_reason\n" + concept,
        "CONCEPT_RELATIONSHIP": "concept_id_1\tconcept_id_2\trelationship_id\tvalid_start_date\tvalid_end_date\tinvalid_reason\n"
        + "\n".join(f"{a}\t{b}\t{r}\t19700101\t20991231\t" for a, b, r in MAPS),
        "VOCABULARY": "vocabulary_id\tvocabulary_name\tvocabulary_reference\tvocabulary_version\tvocabulary_concept_id\n"
        + "\n".join(f"{v}\t{v}\t\t{v} 1\t0" for v in vocabularies) + "\nNone\tRelease\t\tv5.0 2024\t0",
        "CONCEPT_ANCESTOR": "ancestor_concept_id\tdescendant_concept_id\tmin_levels_of_separation\tmax_levels_of_separation\n1\t2\t1\t1",
        "CONCEPT_CLASS": "concept_class_id\tconcept_class_name\tconcept_class_concept_id\nGender\tGender\t1",
        "CONCEPT_SYNONYM": 'concept_id\tconcept_synonym_name\tlanguage_concept_id\n8507\t"M"ale\t1',
        "DRUG_STRENGTH": "drug_concept_id\tingredient_concept_id\tamount_value\n1127433\t1\t2.5",
        "DOMAIN": "domain_id\tdomain_name\tdomain_concept_id\nDrug\tDrug\t13",
        "RELATIONSHIP": "relationship_id\trelationship_name\nMaps to\tMaps to",
    }
    os.makedirs(f"{folder}/vocabulary", exist_ok=True)
    os.makedirs(f"{folder}/extract", exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/vocabulary/{name}.csv", "w") as out:
            out.write(text + "\n")
    for name, text in EXTRACT.items():
        with open(f"{folder}/extract/{name}.csv", "w") as out:
            out.write(text)
    return base


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    config = _files(folder, {
        "concept_csv_file_extension": ".csv", "export_concept_mapping_table_path": f"{folder}/vocabulary/export/",
        "base_path": f"{folder}/extract/", "csv_extension": ".csv", "file_type": "csv",
        "prepared_source_output_location": f"{folder}/staged/", "prepared_source_table_path": f"{folder}/staged/",
        "ohdsi_output_location": f"{folder}/cdm/", "ohdsi_version": "5.4.1",
        "cdm_source": {"cdm_source_name": "Test"},
        "stable_hash_identifiers": {"salt": "x", "s_id_fields": ["s_person_id", "s_encounter_id"]},
        "fact_relationship": [{"source_table_name": "source_relationship", "relationships_to_generate": [
            {"s_relationship": "payer", "ohdsi_table_from": "payer_plan_period", "ohdsi_table_to": "visit_occurrence"}]}],
    })
    build_vocabulary(spark, config)
    stage_extract(spark, config)
    return config


@pytest.fixture(scope="module")
def manifest(spark, config):
    path = config["ohdsi_output_location"] + "manifest.json"
    map_to_cdm(spark, config, path)
    return read_manifest(spark, path)


@pytest.fixture(scope="module")
def cdm(spark, manifest):
    return lambda name: spark.read.parquet(manifest["ohdsi"][name])


def test_vocabulary_keeps_codes_as_text(spark, config):
    tables = load_vocabulary(spark, config["export_concept_mapping_table_path"])
    assert tables["concept"].filter("concept_code = '3.01'").count() == 1
    assert tables["concept_synonym"].first().concept_synonym_name == '"M"ale'
    mapped = tables["concept_map"].filter("source_concept_code = '333'").collect()
    assert sorted((r.relationship_id, r.mapped_concept_id) for r in mapped) == [("Maps to", 4046263), ("Maps to value", 4135493)]


def test_manifest_names_every_table(spark, manifest):
    assert set(manifest) == {"concept", "prepared_source", "ohdsi"}
    assert len(manifest["concept"]) == 9 and len(manifest["prepared_source"]) == 16
    assert set(manifest["ohdsi"]) >= {"person", "note", "episode", "cost", "fact_relationship", "cdm_source", "measurement"}
    for group in manifest.values():
        for path in group.values():
            assert spark.read.parquet(path).columns


def test_persons(cdm):
    rows = {r.person_source_value: r for r in cdm("person").collect()}
    assert (rows["p1"].gender_concept_id, rows["p1"].race_concept_id, rows["p1"].year_of_birth) == (8507, 8527, 1950)
    assert rows["p2"].race_concept_id == 8516 and rows["p2"].location_id is not None
    assert [r.person_id for r in cdm("death").collect()] == [rows["p1"].person_id]


def test_visits(cdm):
    rows = {r.s_id: r for r in cdm("visit_occurrence").collect()}
    assert (rows["e1"].visit_concept_id, rows["e2"].visit_concept_id) == (9201, 9202)
    assert str(rows["e2"].visit_end_date) == "2020-03-01" and str(rows["e1"].visit_end_date) == "2020-01-02"
    assert rows["e1"].visit_type_concept_id == 32827
    assert rows["e1"].provider_id is not None and rows["e1"].care_site_id is not None


def test_conditions_are_routed_by_the_domain_of_their_target(cdm):
    conditions = sorted((r.condition_source_value, r.condition_concept_id, r.visit_occurrence_id is not None)
                        for r in cdm("condition_occurrence").collect())
    # A known source concept without a standard one stays a condition; the reason of an
    # encounter is a condition of its own; duplicate rows and unknown persons are gone.
    assert conditions == [("111", 0, True), ("44054006", 201826, False), ("44054006", 201826, True), ("44054006", 201826, True)]
    routed = [r for r in cdm("measurement").collect() if r.g_source_table_name == "source_condition"]
    assert [(r.measurement_source_value, r.measurement_concept_id) for r in routed] == [("333", 4046263)]


def test_other_facts(cdm):
    drugs = {r.drug_source_value: r for r in cdm("drug_exposure").collect()}
    assert {k: r.drug_concept_id for k, r in drugs.items()} == {"313782|Paracetamol": 1127433, "000|Mystery": 0, "140|Influenza": 40213154}
    assert drugs["313782|Paracetamol"].quantity == 12.0 and drugs["140|Influenza"].drug_type_concept_id == 32817
    lab = cdm("measurement").filter("g_source_table_name = 'source_result'").first()
    assert (lab.value_as_number, lab.unit_concept_id, lab.measurement_concept_id) == (6.5, 8554, 3004410)
    smoking = cdm("observation").first()
    assert (smoking.value_as_concept_id, smoking.visit_occurrence_id, smoking.value_as_number) == (45877985, None, None)
    device = cdm("device_exposure").first()
    assert (device.device_concept_id, device.unique_device_id, str(device.device_exposure_end_date)) == (4217646, "udi-1", "2020-01-01")
    assert cdm("procedure_occurrence").first().procedure_concept_id == 4163872


def test_fact_relationship(cdm):
    (row,) = cdm("fact_relationship").collect()
    visit = cdm("visit_occurrence").filter("s_id = 'e1'").first()
    assert (row.domain_concept_id_1, row.domain_concept_id_2, row.relationship_concept_id) == (32577, 8, 4001)
    assert row.fact_id_2 == visit.visit_occurrence_id
    assert cdm("payer_plan_period").filter(F.col("payer_plan_period_id") == row.fact_id_1).count() == 1


def test_invariants(cdm):
    for table, key in (("condition_occurrence", "condition_occurrence_id"), ("drug_exposure", "drug_exposure_id"),
                       ("measurement", "measurement_id"), ("person", "person_id"), ("visit_occurrence", "visit_occurrence_id")):
        df = cdm(table)
        assert df.select(key).distinct().count() == df.count()
        for column in (c for c in df.columns if c.endswith("_concept_id") and c.startswith(table.split("_")[0])):
            assert df.filter(F.col(column).isNull()).count() == 0, column


def test_a_second_run_yields_the_same_keys(spark, config, cdm):
    again = {**config, "ohdsi_output_location": config["ohdsi_output_location"] + "again/"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        paths = map_to_cdm(spark, again)["ohdsi"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for table in ("condition_occurrence", "measurement", "visit_occurrence", "fact_relationship"):
        assert sorted(map(str, spark.read.parquet(paths[table]).collect())) == sorted(map(str, cdm(table).collect()))


def test_staged_build_and_version_531(spark, config, cdm):
    other = {**config, "ohdsi_output_location": config["ohdsi_output_location"] + "old/", "ohdsi_version": "5.3.1",
             "build_by_stages": {"source_condition": "s_person_id"}, "keep_unmapped": False}
    del other["fact_relationship"], other["stable_hash_identifiers"]
    paths = map_to_cdm(spark, other)["ohdsi"]
    visits = spark.read.parquet(paths["visit_occurrence"])
    assert "admitting_source_concept_id" in visits.columns and "attribute_definition" in paths and "episode" not in paths
    found = spark.read.parquet(paths["condition_occurrence"])
    assert found.count() == cdm("condition_occurrence").count() - 1
    assert spark.read.parquet(paths["fact_relationship"]).count() == 0
    assert "procedure_end_date" not in spark.read.parquet(paths["procedure_occurrence"]).columns


def test_a_run_that_stops_leaves_the_run_before_as_it_was(spark, config, tmp_path, monkeypatch):
    from carestitch.plans import pipeline
    from carestitch.sinks.versions import versions
    versioned = config | {"ohdsi_output_location": f"{tmp_path}/cdm", "keep_versions": 1}
    path = f"{tmp_path}/cdm/manifest.json"
    map_to_cdm(spark, versioned, path)
    before = {t: spark.read.parquet(p).count() for t, p in read_manifest(spark, path)["ohdsi"].items()}
    assert before["person"] > 0 and len(versions(spark, f"{tmp_path}/cdm")) == 1
    whole = pipeline.CdmBuilder._build

    def stops(builder, name):
        if name == "provider":
            raise RuntimeError("stopped midway")
        return whole(builder, name)

    monkeypatch.setattr(pipeline.CdmBuilder, "_build", stops)
    with pytest.raises(RuntimeError):
        map_to_cdm(spark, versioned, path)
    assert len(versions(spark, f"{tmp_path}/cdm")) == 2
    assert {t: spark.read.parquet(p).count() for t, p in read_manifest(spark, path)["ohdsi"].items()} == before
    with pytest.raises(ValueError):
        map_to_cdm(spark, versioned)


def test_report_runs_every_statistic(spark, manifest):
    results = run_report(spark, manifest, extended=True)
    assert len(STANDARD) == 30 and len(EXTENDED) == 8 and set(results) == {*STANDARD, *EXTENDED}
    counts = results["count_deaths"].first()
    assert (counts.n, counts.p_n, counts["n / p_n"]) == (1, 2, 0.5)
    by_concept = results["condition_concepts_count"].collect()
    assert [r.n_r for r in by_concept] == sorted((r.n_r for r in by_concept), reverse=True)
    years = [r.drug_year for r in results["yearly_drug_counts"].collect()]
    assert years == sorted(years, reverse=True)
    for name, df in results.items():
        assert df.collect() is not None, name


def test_publishing(spark, manifest, tmp_path):
    some = {"ohdsi": {t: manifest["ohdsi"][t] for t in ("person", "measurement", "cdm_source")},
            "concept": {t: manifest["concept"][t] for t in ("concept", "vocabulary")}}
    names = publish_tables(spark, some, "cdm_test", str(tmp_path / "db"), fmt="parquet")
    assert len(names) == 5 and spark.table("cdm_test.person").count() == 2
    populate_cdm_source(spark, "cdm_test", {"cdm_version": "CDM v5.4.1", "cdm_holder": "us"}, fmt="parquet")
    (row,) = spark.table("cdm_test.cdm_source").collect()
    assert (row.cdm_source_name, row.vocabulary_version, str(row.source_release_date)) == ("cdm_test", "v5.0 2024", "2020-01-01")
    assert row.cdm_version_concept_id == 756265
    with pytest.raises(ValueError):
        populate_cdm_source(spark, "cdm_test", {}, fmt="parquet")
    spark.sql("drop database cdm_test cascade")


def test_jdbc_names():
    manifest = {"ohdsi": {"person": "p"}, "concept": {"concept": "c"}, "prepared_source": {"source_person": "s"}}
    assert [t.name for t in jdbc_targets(manifest, "dbo")] == ["dbo.transferPERSON", "dbo.transferCONCEPT", "dbo.SOURCE_PERSON"]
    assert [t.table for t in jdbc_targets(manifest, exclude_concepts=True, exclude_source_tables=True)] == ["person"]


def test_stable_id_settings():
    assert not stable_ids({}).person
    chosen = stable_ids({"stable_hash_identifiers": {"salt": "s", "s_id_fields": ["s_person_id"]}})
    assert (chosen.salt, chosen.person, chosen.visit) == ("s", True, False)
    assert chosen.key_of("person") == "person_id" and chosen.key_of("visit_occurrence") is None


def test_repeated_persons_are_reported(spark, config):
    from carestitch.operators.vocab import build_codebook
    from carestitch.plans.cdm import CdmBuilder, StableIds
    people = spark.createDataFrame([(1, "a"), (2, "a")], "g_id bigint, s_person_id string")
    sources = {"source_person": people, "source_location": spark.createDataFrame([], "g_id bigint, k_location string")}
    tables = load_vocabulary(spark, config["export_concept_mapping_table_path"])
    oids = spark.createDataFrame([("o", "Gender")], "oid string, vocabulary_id string")
    book = build_codebook(tables["concept"], tables["concept_map"], oids)
    assert CdmBuilder(spark, sources, book, stable=StableIds("s", person=True)).table("person").count() == 2
    with pytest.raises(ValueError):
        CdmBuilder(spark, sources, book, stable=StableIds("s", person=True, must_be_unique=True)).table("person")


def test_generic_staging(spark, tmp_path):
    (tmp_path / "X_SOURCE_PERSON.csv").write_text('S_PERSON_ID,s_gender,extra\n1,"a ""b"", c",7\n1,"a ""b"", c",7\n')
    config = StagingConfig.from_dict({
        "prepared_source_csv_table_path": f"{tmp_path}/", "prepared_source_table_path": f"{tmp_path}/out/",
        "prepared_source_csv_extension": ".csv", "staging_table_prefix": "X_", "staging_table_uppercase_file_name": True,
        "prepared_source_tables_to_exclude": [t for t in __import__("carestitch.specs", fromlist=["x"]).STAGED_TABLES if t != "source_person"]})
    paths = stage_csv(spark, config)
    (row,) = spark.read.parquet(paths["source_person"]).collect()
    assert (row.s_person_id, row.s_gender, row.extra, row.i_exclude) == ("1", 'a "b", c', "7", None) and row.g_id >= 0
    assert spark.read.parquet(paths["source_note"]).count() == 0


def test_lookup_files(spark, tmp_path):
    (tmp_path / "genders.csv").write_text("concept_name,concept_code\nFEMALE,F\nMALE,M\n")
    df = read_lookup(spark, str(tmp_path / "genders.csv"), "genders")
    assert df.columns == ["concept_name", "concept_code"] and df.count() == 2
    assert spark.table("genders").count() == 2
    spark.catalog.dropTempView("genders")


DOCUMENT = """<?xml version="1.0" encoding="UTF-8"?>
<ClinicalDocument xmlns="urn:hl7-org:v3" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">
 <recordTarget><patientRole><id root="1.2.3"/><patient><administrativeGenderCode code="%s" codeSystem="2.16.840.1.113883.12.1"/>
 <birthTime value="19800203"/></patient></patientRole></recordTarget>
 <component><structuredBody><component><section><code code="10160-0" codeSystem="2.16.840.1.113883.6.1"/>
 <entry><substanceAdministration><id root="m"/><effectiveTime xsi:type="IVL_TS"><high value="20221024000000-0000"/></effectiveTime>
 <consumable><manufacturedProduct><manufacturedMaterial><code code="313782" codeSystem="2.16.840.1.113883.6.88" displayName="Paracetamol"/>
 </manufacturedMaterial></manufacturedProduct></consumable></substanceAdministration></entry></section></component></structuredBody></component>
</ClinicalDocument>"""


def test_documents_of_one_folder_are_one_person(spark, tmp_path):
    for folder, name, gender in (("a", "1", "M"), ("a", "2", ""), ("b", "1", "F")):
        os.makedirs(tmp_path / folder, exist_ok=True)
        (tmp_path / folder / f"{name}.xml").write_text(DOCUMENT % gender)
    paths = stage_documents(spark, str(tmp_path), "salt", f"{tmp_path}/staged")
    people = spark.read.parquet(paths["source_person"]).collect()
    assert sorted(r.s_gender_code for r in people) == ["F", "M"] and len({r.s_person_id for r in people}) == 2
    drugs = spark.read.parquet(paths["source_medication"]).collect()
    assert {(r.s_drug_code, r.s_start_medication_datetime, r.i_exclude) for r in drugs} == {("313782", "2022-10-24 00:00:00", None)}
    period = spark.read.parquet(paths["source_observation_period"]).first()
    assert (period.s_start_observation_datetime, period.s_end_observation_datetime) == ("2022-10-24", "2022-10-24")
    assert spark.read.parquet(paths["source_encounter"]).count() == 0
    assert json.loads(json.dumps(paths))["source_note"]


def test_lookups_can_be_replaced_by_files(spark, config, tmp_path):
    (tmp_path / "race.csv").write_text('value,mapped,code\nwhite,"Other, race",9\n')
    stage_extract(spark, config | {"lookup_files": {"race": f"{tmp_path}/race.csv"}, "prepared_source_output_location": f"{tmp_path}/staged/"})
    rows = {r.s_person_id: r.m_race_code for r in spark.read.parquet(f"{tmp_path}/staged/source_person.parquet").collect()}
    assert rows == {"p1": "9", "p2": None}


def test_published_tables_follow_the_load_rules(spark, manifest, tmp_path):
    from carestitch.sinks.publish import publish_tables
    from carestitch.specs import cdm_specs
    wanted = {"ohdsi": {"person": manifest["ohdsi"]["person"]}}
    publish_tables(spark, wanted, "load_ready", f"{tmp_path}/it's", "parquet", dialect="psql")
    assert spark.table("load_ready.person").columns == list(cdm_specs("5.4")["person"].columns)


def test_the_report_is_written_whole(spark, manifest, tmp_path):
    from carestitch.plans.pipeline import write_report
    paths = write_report(spark, manifest, str(tmp_path))
    assert len(paths) >= 30 and spark.read.parquet(paths["count_people"]).count() == 1
