"""The one-row description of a CDM instance."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.project import align
from ..specs import cdm_specs
from ..specs.cdm import normalise_version

# Version labels as the vocabulary codes them.
CDM_LABELS = {"5.3.1": "CDM v5.3.1", "5.4": "CDM v5.4.1"}
DEFAULT_NAME = "Source mapped to the common data model"
DEFAULT_ABBREVIATION = "cdm"


def vocabulary_release(vocabulary: DataFrame) -> Column:
    """The version of the vocabulary row 'None'."""
    return vocabulary.filter("vocabulary_id = 'None'").agg(F.min("vocabulary_version")).scalar()


def version_concept(concept: DataFrame, label: str) -> Column:
    found = concept.filter("vocabulary_id = 'CDM' and concept_class_id = 'CDM'").filter(
        F.col("concept_code") == label
    )
    return found.agg(F.min("concept_id")).scalar()


def latest_measurement(measurement: DataFrame) -> DataFrame:
    """The latest past measurement date, a proxy for the release date of a source."""
    past = measurement.filter(F.col("measurement_date") < F.current_timestamp())
    return past.agg(F.max("measurement_date").alias("last_measurement_date"))


def _row(spark: SparkSession, values: Mapping[str, Column], version: str) -> DataFrame:
    one = spark.range(1).select([v.alias(n) for n, v in values.items()])
    return align(one, cdm_specs(version)["cdm_source"])


def build_cdm_source(spark: SparkSession, concept: DataFrame, vocabulary: DataFrame,
                     settings: Mapping | None = None, version: str = "5.4",
                     today: datetime.date | None = None) -> DataFrame:
    """The row written by a mapping run, settings first, then defaults."""
    version = normalise_version(version)
    given = dict(settings or {})
    today = today or datetime.datetime.now(datetime.timezone.utc).date()
    defaults = {
        "cdm_source_name": DEFAULT_NAME, "cdm_source_abbreviation": DEFAULT_ABBREVIATION,
        "cdm_holder": "Not specified", "source_release_date": str(today),
        "source_documentation_reference": given.get("source_description_reference"),
    }
    fields = ("cdm_source_name", "cdm_source_abbreviation", "cdm_holder", "source_description",
              "source_documentation_reference", "cdm_etl_reference", "source_release_date")
    values = {f: F.lit(given.get(f, defaults.get(f))).cast("string") for f in fields}
    values |= {"cdm_release_date": F.lit(str(today)), "cdm_version": F.lit(CDM_LABELS[version])}
    if version == "5.4":
        values |= {
            "vocabulary_version": vocabulary_release(vocabulary),
            "cdm_version_concept_id": version_concept(concept, CDM_LABELS[version]),
        }
    return _row(spark, values, version)


def replacement_cdm_source(spark: SparkSession, database: str, metadata: Mapping,
                           table: Callable[[str], DataFrame], today: datetime.date | None = None) -> DataFrame:
    """The row for a published database; missing entries are looked up in its tables."""
    if "cdm_version" not in metadata:
        raise ValueError("cdm_version is required in the metadata")
    today = today or datetime.datetime.now(datetime.timezone.utc).date()
    given = {k: F.lit(str(v)) for k, v in metadata.items() if v is not None}
    if "source_release_date" not in given:
        given["source_release_date"] = latest_measurement(table("measurement")).scalar()
    values = {
        "cdm_source_name": F.lit(database), "cdm_source_abbreviation": F.lit(database),
        "cdm_release_date": F.lit(str(today)),
        "vocabulary_version": vocabulary_release(table("vocabulary")),
        "cdm_version_concept_id": version_concept(table("concept"), metadata["cdm_version"]),
        **given,
    }
    return _row(spark, values, "5.4")


def populate_cdm_source(spark: SparkSession, database: str, metadata: Mapping, fmt: str = "delta") -> None:
    """Replace the rows of ``cdm_source`` in a published database by one new row."""
    row = replacement_cdm_source(spark, database, metadata, lambda t: spark.table(f"`{database}`.`{t}`"))
    row.write.format(fmt).mode("overwrite").saveAsTable(f"`{database}`.`cdm_source`")
