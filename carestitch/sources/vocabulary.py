"""Vocabulary files: read, derive the concept map, export for mapping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.project import align
from ..operators.vocab import build_concept_map
from ..sinks.parquet import export_tables, table_path
from ..specs import VOCABULARY_SPECS, TableSpec
from ..specs.vocabulary import CONCEPT_MAP_COLUMNS

# How the exported tables are laid out.
PARTITION_COLUMNS = {
    "concept": "vocabulary_id",
    "concept_map": "source_vocabulary_id",
    "concept_relationship": "relationship_id",
    "concept_ancestor": "min_levels_of_separation",
}

CONCEPT_MAP_SPEC = TableSpec(
    "concept_map",
    {c: "int" if c.endswith("_concept_id") else "string" for c in CONCEPT_MAP_COLUMNS},
)


def read_vocabulary_file(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """A tab-separated file without quoting; columns are taken by header name."""
    raw = spark.read.option("header", True).option("sep", "\t").option("quote", "").csv(path)
    return align(raw.toDF(*[c.lower() for c in raw.columns]), spec)


def read_vocabulary(spark: SparkSession, base: str, extension: str) -> dict[str, DataFrame]:
    """All nine files; a .bz2 extension is decompressed on the fly."""
    return {
        name: read_vocabulary_file(spark, f"{base}{name.upper()}{extension}", spec)
        for name, spec in VOCABULARY_SPECS.items()
    }


def base_path(config: Mapping) -> str:
    """The folder of the files; by default the parent of the export folder."""
    if "concept_base_path" in config:
        return config["concept_base_path"]
    return "/".join(config["export_concept_mapping_table_path"].split("/")[:-2]) + "/"


def build_vocabulary(spark: SparkSession, config: Mapping) -> dict[str, str]:
    """Stage the vocabulary and its concept map as partitioned Parquet tables.

    ``sample_vocabularies`` in the configuration names vocabularies whose map is sampled to CSV beside them.
    """
    tables = read_vocabulary(spark, base_path(config), config["concept_csv_file_extension"])
    tables["concept_map"] = build_concept_map(
        tables["concept"], tables["concept_relationship"], tables["vocabulary"]
    )
    paths = export_tables(tables, config["export_concept_mapping_table_path"], PARTITION_COLUMNS)
    for name in config.get("sample_vocabularies", ()):
        sample_concepts(spark.read.parquet(paths["concept_map"]), name).write.mode("overwrite").option("header", True).csv(
            f"{config['export_concept_mapping_table_path'].rstrip('/')}/samples/{name}.csv")
    return paths


def load_vocabulary(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Staged vocabulary tables; partition columns keep their declared types."""
    specs = {**VOCABULARY_SPECS, "concept_map": CONCEPT_MAP_SPEC}
    return {
        name: spark.read.schema(spec.schema()).parquet(table_path(base, name)).select(*spec.columns)
        for name, spec in specs.items()
    }


def sample_concepts(concept_map: DataFrame, vocabulary_id: str, rows: int = 1000) -> DataFrame:
    """A sample of one vocabulary's map for inspection: the ``rows`` rows of smallest hash."""
    keys = ["source_concept_id", "relationship_id", "mapped_concept_id"]
    chosen = concept_map.filter(F.col("source_vocabulary_id") == vocabulary_id)
    return chosen.orderBy(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])), *keys).limit(rows)
