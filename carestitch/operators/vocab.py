"""Vocabulary derivations: the concept map and the codebook used to resolve codes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import row_bytes, small

MAPPING_RELATIONSHIPS = ("Maps to", "Maps to value")


def build_concept_map(concept: DataFrame, relationship: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Every source concept with every concept it maps to, and both vocabulary versions."""

    def side(prefix: str) -> DataFrame:
        versions = vocabulary.select(
            F.col("vocabulary_id").alias(f"{prefix}_vocabulary_id"),
            F.col("vocabulary_version").alias(f"{prefix}_vocabulary_version"),
        )
        named = concept.select(
            *[F.col(c).alias(f"{prefix}_{c}") for c in (
                "concept_id", "vocabulary_id", "domain_id", "concept_code",
                "standard_concept", "concept_name")]
        )
        return named.join(versions, f"{prefix}_vocabulary_id")

    links = relationship.filter(F.col("relationship_id").isin(*MAPPING_RELATIONSHIPS)).select(
        F.col("concept_id_1").alias("source_concept_id"),
        F.col("concept_id_2").alias("mapped_concept_id"),
        "relationship_id",
    )
    from ..specs.vocabulary import CONCEPT_MAP_COLUMNS

    return (
        links.join(side("source"), "source_concept_id")
        .join(side("mapped"), "mapped_concept_id")
        .select(*CONCEPT_MAP_COLUMNS)
    )


@dataclass(frozen=True)
class Codebook:
    """What a (oid, concept_code) pair resolves to.

    best     one row per pair: the lowest source concept, its first standard target
             ('Maps to' before 'Maps to value', then lowest id), and the lowest concept
             of the pair that is itself standard.
    targets  one row per pair, source concept and standard target, numbered; a pair
             without target keeps one row with a null target.
    best_bytes, target_bytes  measured sizes if known.
    """

    best: DataFrame
    targets: DataFrame
    best_bytes: int | None = None
    target_bytes: int | None = None

    def of_table(self, source: str) -> "Codebook":
        """The lookups of one staging table: here one codebook serves all."""
        return self

    def of_field(self, prefix: str) -> "Codebook":
        return self

    def restricted_to(self, pairs: DataFrame) -> "Codebook":
        """Only the pairs that occur in the data: (oid, concept_code) rows.

        The used part of a vocabulary is orders of magnitude smaller than the whole, so
        that its lookups become map-side joins once the size has been measured.
        """
        used = pairs.distinct()
        keep = lambda df: df.join(used, ["oid", "concept_code"], "left_semi")
        return Codebook(keep(self.best), keep(self.targets))

    def by_field(self, used: DataFrame, lookups: Sequence[str], fanouts: Sequence[str]) -> "FieldBooks":
        """A codebook for each coded field, of the codes that occur in it.

        used     (field, oid, concept_code) rows
        lookups  fields that take one concept: they need ``best`` only
        fanouts  fields that take all targets: they need ``targets`` only
        """

        def part(df: DataFrame, fields: Sequence[str]) -> DataFrame:
            wanted = used.filter(F.col("field").isin(*fields)).select("field", "oid", "concept_code").distinct()
            return df.join(wanted, ["oid", "concept_code"]).select(*df.columns, "field")

        return FieldBooks(part(self.best, lookups), part(self.targets, fanouts))

    def measured(self) -> "Codebook":
        """Sum the bytes of both parts (call it on materialised frames)."""
        size = lambda df: df.agg(F.sum(row_bytes(df))).first()[0] or 0
        return replace(self, best_bytes=size(self.best), target_bytes=size(self.targets))


def field_name(source: str, prefix: str) -> str:
    return f"{source}.{prefix}"


@dataclass(frozen=True)
class FieldBooks:
    """A codebook for each coded field of each staging table.

    The codes of one field are few where those of another (drugs, say) may be millions:
    kept apart, each lookup is a map-side join or a shuffle by its own size. Written
    partitioned by ``field``, a lookup reads its own partition only.

    best, targets  as in ``Codebook``, with a ``field`` column
    best_bytes, target_bytes  measured sizes by field; a field without rows is not listed
    """

    best: DataFrame
    targets: DataFrame
    best_bytes: Mapping[str, int] | None = None
    target_bytes: Mapping[str, int] | None = None
    source: str = ""

    def of_table(self, source: str) -> "FieldBooks":
        return replace(self, source=source)

    def of_field(self, prefix: str) -> Codebook:
        name = field_name(self.source, prefix)
        part = lambda df: df.filter(F.col("field") == name).drop("field")
        size = lambda sizes: None if sizes is None else sizes.get(name, 0)
        return Codebook(part(self.best), part(self.targets), size(self.best_bytes), size(self.target_bytes))

    def measured(self) -> "FieldBooks":
        """Sum the bytes of each field; as many rows as the model has coded fields come back."""

        def sizes(df: DataFrame) -> dict[str, int]:
            return {r.field: r.size for r in df.groupBy("field").agg(F.sum(row_bytes(df)).alias("size")).collect()}

        return replace(self, best_bytes=sizes(self.best), target_bytes=sizes(self.targets))


@dataclass
class BooksOnDemand:
    """The codebooks of a staging table's fields, cut when the table is first resolved: a run that builds a few model
    tables reads the staging tables of those only.

    cut  the written and measured codebooks of a staging table
    """

    cut: Callable[[str], FieldBooks]
    _books: dict[str, FieldBooks] = field(default_factory=dict)

    def of_table(self, source: str) -> FieldBooks:
        if source not in self._books:
            self._books[source] = self.cut(source).of_table(source)
        return self._books[source]


def coded_concepts(concept: DataFrame, oid_map: DataFrame, oid_rows: int | None = None) -> DataFrame:
    """Concepts under every code-system identifier of their vocabulary."""
    return concept.join(small(oid_map, oid_rows), "vocabulary_id").select(
        "oid", "concept_code", "concept_id", "vocabulary_id", "standard_concept", "domain_id"
    )


def build_codebook(concept: DataFrame, concept_map: DataFrame, oid_map: DataFrame,
                   oid_rows: int | None = None) -> Codebook:
    coded = coded_concepts(concept, oid_map, oid_rows)
    mapped = concept_map.select(
        "source_concept_id", "relationship_id", "mapped_concept_id", "mapped_domain_id",
        "mapped_vocabulary_id",
    )
    # 'Maps to' sorts before 'Maps to value'.
    first_target = mapped.groupBy("source_concept_id").agg(
        F.min(F.struct("relationship_id", "mapped_concept_id", "mapped_domain_id",
                       "mapped_vocabulary_id")).alias("_target")
    )
    chosen = coded.groupBy("oid", "concept_code").agg(
        F.min(F.struct("concept_id", "vocabulary_id", "standard_concept", "domain_id")).alias("_concept"),
        F.min(F.when(F.col("standard_concept") == "S", F.col("concept_id"))).alias("standard_only_id"),
    )
    best = chosen.join(
        first_target, F.col("_concept.concept_id") == F.col("source_concept_id"), "left"
    ).select(
        "oid", "concept_code",
        F.col("_concept.concept_id").alias("concept_id"),
        F.col("_concept.domain_id").alias("domain_id"),
        "standard_only_id",
        F.col("_target.mapped_concept_id").alias("mapped_concept_id"),
        F.col("_target.mapped_domain_id").alias("mapped_domain_id"),
    )
    order = Window.partitionBy("oid", "concept_code").orderBy(
        "concept_id", "relationship_id", "mapped_concept_id"
    )
    targets = (
        coded.join(mapped, F.col("concept_id") == F.col("source_concept_id"), "left")
        .withColumn("ordinal", F.row_number().over(order) - 1)
        .select("oid", "concept_code", "vocabulary_id", "concept_id", "standard_concept",
                "domain_id", "mapped_concept_id", "mapped_vocabulary_id", "mapped_domain_id",
                "relationship_id", "ordinal")
    )
    return Codebook(best, targets)
