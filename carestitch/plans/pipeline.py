"""Whole runs: staged tables in, a written CDM and its manifest out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import distinct_with_row_id, fanout_bits, with_small_ids
from ..operators.project import union_by_name
from ..operators.vocab import build_codebook
from ..sinks.parquet import (
    export_tables, table_path, write_and_reload, write_by_domain, write_by_field, write_manifest, write_staged,
)
from ..sinks.registry import rekeyed
from ..sinks.versions import new_version, prune_versions
from ..sources import ccda
from ..sources.parquet import attach_catalog, load_tables
from ..sources.tabular import dict_table, json_dict_table
from ..sources.vocabulary import load_vocabulary
from ..specs import PSF_SPECS, STAGED_TABLES, VOCABULARY_SPECS
from ..specs.cdm import cdm_specs, normalise_version
from ..specs.vocabulary import OID_TO_VOCABULARY
from . import builds as B
from .cdm import CdmBuilder, StableIds
from .cdm_source import build_cdm_source
from .relationships import build_fact_relationship, relationships_from_config, unknown_links
from .stats import report

# Groups of the manifest.
CONCEPT_GROUP, SOURCE_GROUP, CDM_GROUP = "concept", "prepared_source", "ohdsi"


def stable_ids(config: Mapping) -> StableIds:
    """Which keys are salted hashes instead of row ids."""
    wanted = config.get("stable_hash_identifiers")
    if not wanted:
        return StableIds()
    fields = wanted.get("s_id_fields", ())
    return StableIds(wanted["salt"], "s_person_id" in fields, "s_encounter_id" in fields,
                     wanted.get("must_be_unique", False))


def oid_table(spark: SparkSession, config: Mapping) -> tuple[DataFrame, int | None]:
    """The code-system map; a configured JSON file replaces the built-in one."""
    columns = ("oid", "vocabulary_id")
    if "oid_to_vocabulary_path" in config:
        return json_dict_table(spark, config["oid_to_vocabulary_path"], columns), None
    return dict_table(spark, OID_TO_VOCABULARY, columns), len(OID_TO_VOCABULARY)


def map_to_cdm(spark: SparkSession, config: Mapping, manifest_path: str | None = None,
               write_cdm_source: bool = True) -> dict[str, dict[str, str]]:
    """Build every CDM table from staged tables; returns (and writes) the manifest.

    Each table is written once and read back, so a lost executor costs at most the stage
    of one table and plans stay small. With ``keep_versions`` in the configuration the run
    writes to a folder of its own below the output location, the manifest is swapped last,
    and that many runs are kept.
    """
    output = config["ohdsi_output_location"]
    kept = config.get("keep_versions")
    if kept is not None:
        if not manifest_path or kept < 1:
            raise ValueError("keep_versions is 1 at least and needs a manifest, which names the finished run")
        output = new_version(output)
    vocabulary_base = config["export_concept_mapping_table_path"]
    source_base = config["prepared_source_table_path"]
    version = normalise_version(config.get("ohdsi_version", "5.4"))
    staged_by = config.get("build_by_stages", {})

    vocabulary = load_vocabulary(spark, vocabulary_base)
    oids, oid_rows = oid_table(spark, config)

    def write(name: str, df: DataFrame) -> DataFrame:
        path = table_path(output, name)
        if name.endswith("_matched"):
            source = name.removeprefix("support/").removesuffix("_matched")
            return write_staged(df, path, staged_by[source]) if source in staged_by else write_by_domain(df, path)
        if name in ("support/codes", "support/code_targets"):
            return write_by_field(df, path)
        return write_and_reload(df, path)

    sources = load_tables(spark, STAGED_TABLES, source_base)
    whole = build_codebook(vocabulary["concept"], vocabulary["concept_map"], oids, oid_rows)
    builder = CdmBuilder(
        spark, sources, whole, version, stable_ids(config),
        keep_unmapped=config.get("keep_unmapped", True), materialise=write, measure=True,
        keep_columns=frozenset(staged_by.values()),
    )
    # Only the codes a field uses are looked up in it; their size is known before any join.
    builder.codebook = builder.field_books(whole, write)
    builder.fanout_bits = fanout_bits(builder.codebook.targets.agg(F.max("ordinal")).first()[0] or 0)
    builder.sources = sources | {b.source: with_small_ids(sources[b.source], builder.fanout_bits) for b in B.FACTS}
    names = builder.table_names()
    for name in names:
        builder.table(name)
    write("cdm_source", build_cdm_source(
        spark, vocabulary["concept"], vocabulary["vocabulary"], config.get("cdm_source"), version,
    ) if write_cdm_source else cdm_specs(version)["cdm_source"].empty(spark))

    linked = [
        build_fact_relationship(
            spark.read.parquet(table_path(source_base, table)), wanted, sources.__getitem__,
            builder.table, vocabulary["concept"], oids, lambda index, t=table: write(f"support/{t}_key_index", index))
        for table, wanted in relationships_from_config(config).items()
    ] or [cdm_specs(version)["fact_relationship"].empty(spark)]
    for table in relationships_from_config(config):
        unknown = unknown_links(spark.read.parquet(table_path(source_base, table)), sources.__getitem__)
        write(f"support/{table}_unknown_links", unknown)
    write_and_reload(union_by_name(linked), table_path(output, "fact_relationship"), "relationship_concept_id")

    manifest = {
        CONCEPT_GROUP: {n: table_path(vocabulary_base, n) for n in VOCABULARY_SPECS},
        SOURCE_GROUP: {n: table_path(source_base, n) for n in STAGED_TABLES},
        CDM_GROUP: {n: table_path(output, n) for n in (*names, "cdm_source", "fact_relationship")},
    }
    if manifest_path:
        write_manifest(spark, manifest, manifest_path)
    if kept is not None:
        prune_versions(spark, config["ohdsi_output_location"], output, kept)
    return manifest


def stage_documents(spark: SparkSession, path: str, salt: str, output: str, registry: str | None = None) -> dict[str, str]:
    """C-CDA documents below a folder to staged tables; tables they do not feed are empty. With a ``registry`` folder
    rows keep their ids over deliveries."""
    documents = ccda.parse_documents(ccda.read_documents(spark, path, salt))
    parsed = write_and_reload(documents, table_path(output, "support/documents"))
    write_and_reload(ccda.rejected_documents(parsed), table_path(output, "support/rejected_documents"))
    tables = ccda.combine_fragments(ccda.extract_fragments(parsed))
    staged = {name: distinct_with_row_id(df) for name, df in tables.items()}
    if registry:
        staged = rekeyed(staged, registry)
    for name in STAGED_TABLES:
        staged.setdefault(name, PSF_SPECS[name].empty(spark, g_id="bigint"))
    return export_tables(staged, output)


def run_report(spark: SparkSession, manifest: Mapping[str, Mapping[str, str]], extended: bool = False) -> dict[str, DataFrame]:
    """The descriptive statistics over the tables of a manifest."""
    attached = attach_catalog(spark, manifest)
    tables = {name: df for group in attached.values() for name, df in group.items()}
    return report(tables.__getitem__, extended)


def write_report(spark: SparkSession, manifest: Mapping[str, Mapping[str, str]], output: str,
                 extended: bool = False) -> dict[str, str]:
    """Every statistic as a whole table below a folder; returns their paths."""
    return export_tables(run_report(spark, manifest, extended), output)
