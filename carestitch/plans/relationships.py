"""fact_relationship: pairs of CDM rows that a staging relationship links."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import staged_id
from ..operators.project import union_by_name
from ..specs import PSF_SPECS, cdm_spec
from ..specs.cdm import LINEAGE

# CDM table → name of its domain concept.
DOMAIN_OF_TABLE = {
    "person": "Person",
    "provider": "Provider",
    "visit_occurrence": "Visit",
    "payer_plan_period": "Payer - institution administering healthcare transactions",
    "condition_occurrence": "Condition",
    "procedure_occurrence": "Procedure",
    "drug_exposure": "Drug",
    "measurement": "Measurement",
    "observation": "Observation",
    "device_exposure": "Device",
    "note": "Note",
    "care_site": "Care site",
}

_LINK = ("s_target_from_table_name", "s_target_from_table_field",
         "s_target_to_table_name", "s_target_to_table_field")
_CODE = ("s_relationship_code", "s_relationship_code_type_oid")


def _known_ends(links: DataFrame, source: Callable[[str], DataFrame]) -> Column:
    """Whether both ends of a link name a staging table and one of its columns."""
    pairs = [_LINK[:2], _LINK[2:]]
    tables = [F.col(table).isin(list(PSF_SPECS)) for table, _ in pairs]
    used = links.filter(tables[0] & tables[1]).select(pairs[0][0], pairs[1][0]).distinct().collect()  # pairs of tables
    fields = [f"{table}.{field}" for table in {t for row in used for t in row} for field in source(table).columns]
    ends = [F.concat(table, F.lit("."), field).isin(fields) for table, field in pairs]
    return F.coalesce(ends[0] & ends[1], F.lit(False))


def unknown_links(links: DataFrame, source: Callable[[str], DataFrame]) -> DataFrame:
    """Links that name no staging table or column, counted by what they name."""
    return links.filter(~_known_ends(links, source)).groupBy("s_relationship", *_LINK).agg(F.count(F.lit(1)).alias("n_rows"))


@dataclass(frozen=True)
class Relationship:
    s_relationship: str
    table_from: str
    table_to: str


def _named_rows(source: DataFrame, table: str, fields: list[str]) -> DataFrame:
    """(source_table, field, value, row): the values of the fields by which links may name a staging row."""
    named = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return source.select(
        F.lit(table).alias("source_table"), F.col(staged_id(source)).alias("row"), F.inline(named)
    ).filter("value is not null")


def key_index(links: DataFrame, wanted: list[Relationship], source: Callable[[str], DataFrame],
              cdm: Callable[[str], DataFrame]) -> DataFrame | None:
    """(cdm_table, source_table, field, value, fact_id): which CDM rows were made from the staging row that
    a value names. None if no known link is wanted.

    Each staging table in use is read once for all of its fields that links name, each CDM table once; a single
    join on (staging table, row) brings both together. The fields in use are collected: no more than the staging
    tables have columns.
    """
    rows = links.filter(_known_ends(links, source) & F.col("s_relationship").isin([r.s_relationship for r in wanted]))
    ends = F.array(*[F.struct(F.col(t).alias("table"), F.col(f).alias("field")) for t, f in (_LINK[:2], _LINK[2:])])
    used: dict[str, list[str]] = {}
    for end in rows.select(F.explode(ends).alias("end")).select("end.*").distinct().collect():
        used.setdefault(end.table, []).append(end.field)
    if not used:
        return None
    named = union_by_name([_named_rows(source(table), table, sorted(fields)) for table, fields in sorted(used.items())])
    made = union_by_name([
        cdm(table).filter(F.col("g_source_table_name").isin(list(used))).select(
            F.lit(table).alias("cdm_table"), F.col("g_source_table_name").alias("source_table"),
            F.col("s_g_id").alias("row"), F.col(f"{table}_id").cast("bigint").alias("fact_id"))
        for table in sorted({t for r in wanted for t in (r.table_from, r.table_to)})
    ])
    return named.join(made, ["source_table", "row"]).select("cdm_table", "source_table", "field", "value", "fact_id")


def build_fact_relationship(links: DataFrame, wanted: list[Relationship],
                            source: Callable[[str], DataFrame], cdm: Callable[[str], DataFrame],
                            concept: DataFrame, oid_map: DataFrame,
                            keep: Callable[[DataFrame], DataFrame] = lambda index: index) -> DataFrame:
    """One row per staging relationship whose two ends became CDM rows.

    Which tables and fields the two ends name is data, checked against the staging tables (``unknown_links`` counts
    the others). Both ends are looked up in one index of the values that name staging rows (``keep`` may write it):
    one join for each end, whatever the number of combinations. Relationship codes are data as well and resolved by a
    join with the codes in use.
    """
    index = key_index(links, wanted, source, cdm)
    if index is None:
        return cdm_spec("fact_relationship").empty(links.sparkSession).drop(*LINEAGE)
    index = keep(index)
    domains = concept.filter("domain_id = 'Metadata' and vocabulary_id = 'Domain'")

    def domain_id(column: str) -> Column:
        found = {t: domains.filter(F.col("concept_name") == DOMAIN_OF_TABLE[t]).agg(F.min("concept_id")).scalar()
                 for t in sorted({t for r in wanted for t in (r.table_from, r.table_to)})}
        return F.coalesce(*[F.when(F.col(column) == table, concept_id) for table, concept_id in found.items()], F.lit(0))

    coded = concept.join(oid_map, "vocabulary_id").select(F.col("concept_code").alias(_CODE[0]), F.col("oid").alias(_CODE[1]), "concept_id")
    known = links.filter(_known_ends(links, source))
    codes = known.select(*_CODE).distinct().join(coded, list(_CODE)).groupBy(*_CODE).agg(F.min("concept_id").alias("relationship_concept_id"))
    rules = F.array(*[F.struct(F.lit(r.s_relationship).alias("name"), F.lit(r.table_from).alias("cdm_1"), F.lit(r.table_to).alias("cdm_2")) for r in wanted])
    rows = known.select(
        "*", F.explode(F.filter(rules, lambda r: r["name"] == F.col("s_relationship"))).alias("rule")
    ).join(codes, list(_CODE), "left").select(
        F.col("rule.cdm_1").alias("cdm_1"), F.col("rule.cdm_2").alias("cdm_2"),
        *[F.col(c).alias(n) for c, n in zip((*_LINK, "s_target_from_value", "s_target_to_value"),
                                           ("table_1", "field_1", "table_2", "field_2", "value_1", "value_2"))],
        F.coalesce("relationship_concept_id", F.lit(0)).alias("relationship_concept_id"),
    )
    for side in ("1", "2"):
        end = index.select(F.col("cdm_table").alias(f"cdm_{side}"), F.col("source_table").alias(f"table_{side}"),
                           F.col("field").alias(f"field_{side}"), F.col("value").alias(f"value_{side}"),
                           F.col("fact_id").alias(f"fact_id_{side}"))
        rows = rows.join(end, [f"{c}_{side}" for c in ("cdm", "table", "field", "value")])
    return rows.select(
        domain_id("cdm_1").alias("domain_concept_id_1"), "fact_id_1",
        domain_id("cdm_2").alias("domain_concept_id_2"), "fact_id_2", "relationship_concept_id",
    )


def relationships_from_config(config: Mapping) -> dict[str, list[Relationship]]:
    """Staging table → relationships to generate from it."""
    return {
        entry["source_table_name"]: [
            Relationship(r["s_relationship"], r["ohdsi_table_from"], r["ohdsi_table_to"])
            for r in entry["relationships_to_generate"]
        ]
        for entry in config.get("fact_relationship", [])
    }
