"""Synthetic-EHR CSV extracts to staging tables.

Input: the extract's tables as frames with lower-case string columns. Each function yields
one staging table; columns of its layout that the extract does not have are null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import composite_id, distinct_with_row_id, location_key
from ..operators.joins import lookup_value_code, payer_at_encounter, unique_by
from ..operators.project import align, split_by_type, union_by_name
from ..sinks.parquet import export_tables
from ..sinks.registry import rekeyed
from ..specs import PSF_SPECS
from .tabular import read_lookup, read_tables, rejected_rows

SOURCE_SYSTEM = "synthea"

EXTRACT_TABLES = (
    "conditions", "devices", "encounters", "immunizations", "medications", "observations",
    "organizations", "patients", "payers", "payer_transitions", "procedures", "providers",
)

# Source value → (mapped value, mapped code), with code type and identifier.
LOOKUPS = {
    "race": ("Race", "ohdsi.race", {
        "asian": ("Asian", "2"),
        "black": ("Black", "3.01"),
        "native": ("American Indian or Alaska Native", "1"),
        "white": ("White", "5"),
    }),
    "ethnicity": ("Ethnicity", "ohdsi.ethnicity", {
        "hispanic": ("Hispanic or Latino", "Hispanic"),
        "nonhispanic": ("Not Hispanic or Latino", "Not Hispanic"),
    }),
    "gender": ("Administrative sex (HL7)", "2.16.840.1.113883.12.1", {
        "F": ("Female", "F"),
        "M": ("Male", "M"),
    }),
    "specialty": ("NUCC", "2.16.840.1.113883.6.101", {
        "GENERAL PRACTICE": ("General Practice Physician", "208D00000X"),
    }),
    "visit_type": ("Visit", "ohdsi.visit", {
        "ambulatory": ("Outpatient Visit", "OP"),
        "emergency": ("Emergency Room Visit", "ER"),
        "inpatient": ("Inpatient Visit", "IP"),
        "outpatient": ("Outpatient Visit", "OP"),
        "urgentcare": ("Outpatient Visit", "OP"),
        "wellness": ("Outpatient Visit", "OP"),
    }),
    "payer": ("SOPT", "nahdo.sopt", {
        "Aetna": ("Private Health Insurance", "5"),
        "Anthem": ("Private Health Insurance", "5"),
        "Blue Cross Blue Shield": ("Blue Cross/Blue Shield", "6"),
        "Cigna Health": ("Private Health Insurance", "5"),
        "Dual Eligible": ("Dual Eligibility Medicare/Medicaid", "14"),
        "Humana": ("Private Health Insurance", "5"),
        "Medicaid": ("Medicaid", "2"),
        "Medicare": ("Medicare", "1"),
        "NO_INSURANCE": ("Self-pay", "81"),
        "UnitedHealthcare": ("Private Health Insurance", "5"),
    }),
    # Result texts without a code are left out: they map to nothing either way.
    "result": ("LOINC", "2.16.840.1.113883.6.1", {
        "Negative (qualifier value)": (None, "LA6577-6"),
        "Not detected (qualifier value)": (None, "LA11883-8"),
        "Detected (qualifier value)": (None, "LA11882-0"),
        "Positive (qualifier value)": (None, "LA6576-8"),
    }),
}

# Code systems and type concepts.
SNOMED = ("SNOMED", "2.16.840.1.113883.6.96")
RXNORM = ("RxNorm", "2.16.840.1.113883.6.88")
CVX = ("CVX", "2.16.840.1.113883.12.292")
LOINC = ("LOINC", "2.16.840.1.113883.6.1")
UCUM = ("UCUM", "2.16.840.1.113883.4.642.3.912")
EHR_TYPE = ("EHR", "OMOP4976890", "Type", "ohdsi.type_concept")
EHR_PERIOD_TYPE = ("EHR", "OMOP4976890", "OHDSI", "ohdsi.type_concept")
ENCOUNTER_TYPE = ("EHR Encounter Record", "OMOP4976900", "Type", "ohdsi.type_concept")
PRIMARY_DIAGNOSIS = ("Primary diagnosis", "OMOP4976972", "Condition status", "ohdsi.condition_status")
PAYER_RELATIONSHIP = ("payer", "4001000175104", *SNOMED)

Extract = Callable[[str], DataFrame]


def lookup_table(spark: SparkSession, name: str, lookups: Mapping = LOOKUPS) -> tuple[DataFrame, int | None]:
    """A lookup as a table (s_x, m_x and its code columns), with its number of rows, if that is known: a lookup
    out of a file is a frame of any size."""
    code_type, oid, values = lookups[name]
    if isinstance(values, DataFrame):
        one = unique_by(values, ["value"], ["mapped", "code"])
        return one.select(F.col("value").alias(f"s_{name}"), F.col("mapped").alias(f"m_{name}"), F.col("code").alias(f"m_{name}_code"),
                          F.lit(code_type).alias(f"m_{name}_code_type"), F.lit(oid).alias(f"m_{name}_code_type_oid")), None
    rows = [(s, m, code, code_type, oid) for s, (m, code) in values.items()]
    columns = [f"s_{name}", f"m_{name}", f"m_{name}_code", f"m_{name}_code_type", f"m_{name}_code_type_oid"]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)), len(rows)


def _with_lookup(df: DataFrame, value: str, name: str, lookups: Mapping, when: Column | None = None) -> DataFrame:
    table, rows = lookup_table(df.sparkSession, name, lookups)
    keyed = table.withColumn("_match", F.col(f"s_{name}"))
    return lookup_value_code(df, keyed, value, "_match", when, rows)


def _constants(stem: str, values: tuple) -> dict[str, Column]:
    return {f"{stem}{suffix}": F.lit(v) for suffix, v in zip(("", "_code", "_code_type", "_code_type_oid"), values)}


def _system(stem: str, system: tuple[str, str]) -> dict[str, Column]:
    """Code type and identifier of a field whose codes all belong to one system."""
    return {f"{stem}_code_type": F.lit(system[0]), f"{stem}_code_type_oid": F.lit(system[1])}


def _pick(df: DataFrame, columns: Mapping[str, Column | str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Staging columns out of an extract table; strings name its columns."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()], *keep)


def _stage(name: str, rows: DataFrame, constants: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct rows with an id, then everything that is the same in all of them: only the
    columns that vary are shuffled."""
    filled = distinct_with_row_id(rows).withColumns(dict(constants or {}))
    return align(filled, PSF_SPECS[name], keep_others=True)


_EVENT = {"s_person_id": "patient", "s_encounter_id": "encounter"}
_ADDRESS = ("address", "city", "state", "zip")


def _origin() -> dict[str, Column]:
    return {"s_source_system": F.lit(SOURCE_SYSTEM)}


def _mapped(name: str) -> tuple[str, ...]:
    return tuple(f"m_{name}{suffix}" for suffix in ("", "_code", "_code_type", "_code_type_oid"))


def locations(extract: Extract) -> DataFrame:
    def places(table: str, county: Column) -> DataFrame:
        return _pick(extract(table), {
            "k_location": location_key(*_ADDRESS), "s_address_1": "address", "s_city": "city",
            "s_state": "state", "s_zip": "zip", "s_county": county, "s_latitude": "lat", "s_longitude": "lon",
        })

    both = union_by_name([places("patients", F.col("county")), places("organizations", F.lit(None).cast("string"))])
    return _stage("source_location", both, {"s_country": F.lit("U.S.A.")})


def persons(extract: Extract, lookups: Mapping = LOOKUPS) -> DataFrame:
    df = extract("patients")
    names = ("race", "ethnicity", "gender")
    for name in names:
        df = _with_lookup(df, name, name, lookups)
    rows = _pick(df, {
        "s_person_id": "id", "s_birth_datetime": "birthdate", "s_death_datetime": "deathdate",
        **{f"s_{n}": F.col(n) for n in names}, "k_location": location_key(*_ADDRESS), "s_id": "id",
    }, tuple(c for n in names for c in _mapped(n)))
    return _stage("source_person", rows, _origin())


def care_sites(extract: Extract) -> DataFrame:
    return _stage("source_care_site", _pick(extract("organizations"), {
        "k_care_site": "id", "s_care_site_name": "name", "k_location": location_key(*_ADDRESS)}))


def providers(extract: Extract, lookups: Mapping = LOOKUPS) -> DataFrame:
    df = _with_lookup(extract("providers"), "speciality", "specialty", lookups)
    df = _with_lookup(df, "gender", "gender", lookups)
    return _stage("source_provider", _pick(df, {
        "k_provider": "id", "s_provider_name": "name", "k_care_site": "organization",
    }, ("s_specialty", *_mapped("specialty"), "s_gender", *_mapped("gender"))))


def encounters(extract: Extract, lookups: Mapping = LOOKUPS) -> DataFrame:
    df = _with_lookup(extract("encounters"), "encounterclass", "visit_type", lookups)
    rows = _pick(df, {
        "s_encounter_id": "id", "s_person_id": "patient", "s_visit_start_datetime": "start",
        "s_visit_end_datetime": "stop", "s_visit_type": "encounterclass",
        "k_care_site": "organization", "k_provider": "provider", "s_id": "id",
    }, _mapped("visit_type"))
    return _stage("source_encounter", rows, {**_constants("m_visit_source", ENCOUNTER_TYPE), **_origin()})


def observation_periods(encounter: DataFrame) -> DataFrame:
    """First start to last end (or start) of a person's encounters that count."""
    kept = encounter.filter(F.col("i_exclude").isNull() | (F.col("i_exclude") == "0"))
    spans = kept.groupBy("s_person_id").agg(
        F.min("s_visit_start_datetime").alias("s_start_observation_datetime"),
        F.max(F.coalesce("s_visit_end_datetime", "s_visit_start_datetime")).alias("s_end_observation_datetime"),
    )
    return _stage("source_observation_period", spans, _constants("m_source", EHR_PERIOD_TYPE))


def payers(extract: Extract, lookups: Mapping = LOOKUPS) -> DataFrame:
    """Insurance periods; payers without a mapped code are left out. The row identifier
    is a hash of the row, so it is the same on every run. The layout has none, but
    relationships refer to it."""
    names = extract("payers").select(F.col("id").alias("payer"), "name")
    spans = extract("payer_transitions").join(names, "payer")
    mapped = _with_lookup(spans, "name", "payer", lookups).filter("m_payer_code is not null")
    fields = [F.coalesce(F.col(c), F.lit("")) for c in ("patient", "start_date", "end_date", "payer")]
    return _stage("source_payer", _pick(mapped, {
        "s_id": F.sha1(F.concat_ws("|", *fields)), "s_person_id": "patient",
        "s_payer_start_datetime": F.col("start_date").try_cast("timestamp").cast("string"),
        "s_payer_end_datetime": F.col("end_date").try_cast("timestamp").cast("string"), "s_payer": "name",
    }, _mapped("payer")))


def payer_relationships(payer: DataFrame, encounter: DataFrame) -> DataFrame:
    """Which payer period covers an encounter."""
    sides = encounter.select("s_encounter_id", "s_person_id", "s_visit_start_datetime",
                             "s_visit_end_datetime", F.col("s_id").alias("_row"))
    periods = payer.select("s_person_id", "s_payer_start_datetime", "s_payer_end_datetime",
                           F.col("s_id").alias("_payer_row"))
    rows = _pick(payer_at_encounter(sides, periods), {
        "s_id": composite_id("s_encounter_id", "_row"),
        "s_target_from_value": "_payer_row", "s_target_to_value": "s_encounter_id",
    })
    return _stage("source_relationship", rows, {
        **_constants("s_relationship", PAYER_RELATIONSHIP),
        "s_target_from_table_name": F.lit("source_payer"), "s_target_from_table_field": F.lit("s_id"),
        "s_target_to_table_name": F.lit("source_encounter"), "s_target_to_table_field": F.lit("s_encounter_id"),
    })


def conditions(extract: Extract) -> DataFrame:
    """Coded conditions, and the reason of each encounter as a primary diagnosis."""
    def coded(df: DataFrame, encounter: str, code: str, status: str | None) -> DataFrame:
        return _pick(df, {
            "s_person_id": "patient", "s_encounter_id": encounter, "s_start_condition_datetime": "start",
            "s_end_condition_datetime": "stop", "s_condition_code": code,
            "s_condition_status": F.lit(status).cast("string"),
        })

    both = union_by_name([
        coded(extract("conditions"), "encounter", "code", None),
        coded(extract("encounters").filter("reasoncode is not null"), "id", "reasoncode", "Reason"),
    ])
    is_reason = F.col("s_condition_status") == "Reason"
    return _stage("source_condition", both, {
        **_system("s_condition", SNOMED), **_constants("m_condition_type", EHR_TYPE),
        **{n: F.when(is_reason, v) for n, v in _constants("m_condition_status", PRIMARY_DIAGNOSIS).items()},
        **_origin(),
    })


def procedures(extract: Extract) -> DataFrame:
    rows = _pick(extract("procedures"), {
        **_EVENT, "s_start_procedure_datetime": "start", "s_end_procedure_datetime": "stop", "s_procedure_code": "code"})
    return _stage("source_procedure", rows, {
        **_system("s_procedure", SNOMED), **_constants("m_procedure_type", EHR_TYPE), **_origin()})


def devices(extract: Extract) -> DataFrame:
    rows = _pick(extract("devices"), {
        **_EVENT, "s_start_device_datetime": "start", "s_end_device_datetime": F.coalesce("stop", "start"),
        "s_device": "description", "s_device_code": "code", "s_unique_device_identifier": "udi"})
    return _stage("source_device", rows, {
        **_system("s_device", SNOMED), **_constants("m_device_type", EHR_TYPE), **_origin()})


def medications(extract: Extract) -> DataFrame:
    """Prescriptions and immunisations, each under its own code system."""
    def drugs(df: DataFrame, system: tuple[str, str], start: str, end: Column, quantity: Column) -> DataFrame:
        return _pick(df, {
            **_EVENT, "s_drug_code": "code", "s_drug_code_type": F.lit(system[0]), "s_drug_text": "description",
            "s_start_medication_datetime": start, "s_end_medication_datetime": end, "s_quantity": quantity})

    both = union_by_name([
        drugs(extract("medications"), RXNORM, "start", F.coalesce("stop", "start"), F.col("dispenses")),
        drugs(extract("immunizations"), CVX, "date", F.col("date"), F.lit(None).cast("string")),
    ])
    oid = F.when(F.col("s_drug_code_type") == RXNORM[0], F.lit(RXNORM[1])).otherwise(F.lit(CVX[1]))
    return _stage("source_medication", both, {
        "s_drug_code_type_oid": oid, **_constants("m_drug_type", EHR_TYPE), **_origin()})


def results(extract: Extract, lookups: Mapping = LOOKUPS) -> DataFrame:
    """Observations; texts are looked up for a code, numbers are not."""
    df = _with_lookup(extract("observations"), "value", "result", lookups, when=F.col("type") == "text")
    rows = _pick(df, {
        **_EVENT, "s_obtained_datetime": "date", "s_name": "description", "s_code": "code",
        "s_result_text": split_by_type("value", "type", "text"),
        "s_result_numeric": split_by_type("value", "type", "numeric"),
        "s_result_unit": "units", "s_result_unit_code": "units",
    }, _mapped("result")[1:])
    typed = _constants("m_source", EHR_TYPE)
    typed["s_source"] = typed.pop("m_source")
    return _stage("source_result", rows, {**_system("s", LOINC), **_system("s_result_unit", UCUM), **typed, **_origin()})


EMPTY_TABLES = ("source_encounter_detail", "source_person_map", "source_encounter_map", "source_note")


def staging_tables(spark: SparkSession, extract: Extract, lookups: Mapping = LOOKUPS) -> dict[str, DataFrame]:
    """Every staging table of an extract, with row ids."""
    encounter, payer = encounters(extract, lookups), payers(extract, lookups)
    tables = {
        "source_location": locations(extract), "source_person": persons(extract, lookups),
        "source_care_site": care_sites(extract), "source_provider": providers(extract, lookups),
        "source_encounter": encounter, "source_observation_period": observation_periods(encounter),
        "source_payer": payer, "source_relationship": payer_relationships(payer, encounter),
        "source_condition": conditions(extract), "source_procedure": procedures(extract),
        "source_device": devices(extract), "source_medication": medications(extract),
        "source_result": results(extract, lookups),
    }
    return tables | {name: PSF_SPECS[name].empty(spark, g_id="bigint") for name in EMPTY_TABLES}


# Tables with names and addresses, whose texts may hold line breaks. Files of events have none and are split.
MULTI_LINE_TABLES = ("patients", "organizations", "providers", "payers")


def stage_extract(spark: SparkSession, config: Mapping) -> dict[str, str]:
    """Read an extract's CSVs and write its staging tables; returns their paths.

    ``lookup_files`` in the configuration replaces lookups by name: CSVs with the columns
    value, mapped and code. With ``key_registry_path`` rows keep their ids over deliveries.
    Damaged rows go to ``support/rejected_rows``.
    """
    lookups = dict(LOOKUPS)
    for name, path in config.get("lookup_files", {}).items():
        lookups[name] = (*LOOKUPS[name][:2], read_lookup(spark, path).select("value", "mapped", "code"))
    files, output = {t: t for t in EXTRACT_TABLES}, config["prepared_source_output_location"]
    where = (config["base_path"], config["csv_extension"], config["file_type"])
    multi_line = config.get("multi_line", MULTI_LINE_TABLES)
    export_tables({"support/rejected_rows": rejected_rows(spark, files, *where, multi_line)}, output)
    tables = staging_tables(spark, read_tables(spark, files, *where, multi_line=multi_line).__getitem__, lookups)
    if "key_registry_path" in config:
        tables = rekeyed(tables, config["key_registry_path"])
    return export_tables(tables, output)
