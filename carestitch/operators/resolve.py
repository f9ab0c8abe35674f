"""Code resolution: staging codes to source and standard concepts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import concept_or_zero
from .joins import small_in_bytes
from .project import has_code
from .vocab import Codebook, FieldBooks, field_name


def code_columns(prefix: str) -> tuple[str, str]:
    return f"{prefix}_code", f"{prefix}_code_type_oid"


@dataclass(frozen=True)
class CodedField:
    """How one coded field of a table is resolved.

    candidates     staging prefixes, best first ("m_gender", "s_gender")
    concept        output column of the standard concept
    source         output column of the source concept, if wanted
    domain         concepts of another domain become 0
    standard_only  take the code's own concept if it is standard, without a mapping hop
    mapped_domain  output column of the standard concept's domain, if wanted
    """

    concept: str
    candidates: tuple[str, ...]
    source: str | None = None
    domain: str | None = None
    standard_only: bool = False
    mapped_domain: str | None = None


def _attach_best(df: DataFrame, books: Codebook | FieldBooks, prefix: str, level: int, columns: Sequence[str]) -> DataFrame:
    code, oid = code_columns(prefix)
    book = books.of_field(prefix)
    side = book.best.select(
        F.col("oid").alias(f"_oid_{level}"), F.col("concept_code").alias(f"_code_{level}"),
        *[F.col(c).alias(f"_{c}_{level}") for c in columns],
    )
    condition = (F.col(oid) == F.col(f"_oid_{level}")) & (F.col(code) == F.col(f"_code_{level}"))
    return df.join(small_in_bytes(side, book.best_bytes), condition, "left").drop(f"_oid_{level}", f"_code_{level}")


def resolve_field(df: DataFrame, book: Codebook | FieldBooks, field: CodedField) -> DataFrame:
    """Resolve one field in place: a left lookup per candidate, no self-join, no window.

    The first candidate whose code is a known concept wins, also if that concept maps to
    nothing standard; then the standard concept is 0.
    """
    if field.standard_only:
        (prefix,) = field.candidates
        found = _attach_best(df, book, prefix, 0, ["standard_only_id"])
        return found.withColumn(field.concept, concept_or_zero("_standard_only_id_0")).drop("_standard_only_id_0")

    columns = ["concept_id", "mapped_concept_id", "mapped_domain_id"]
    found = df
    for level, prefix in enumerate(field.candidates):
        found = _attach_best(found, book, prefix, level, columns)

    def winner(column: str):
        choice = F.lit(None)
        for level in reversed(range(len(field.candidates))):
            choice = F.when(
                F.col(f"_concept_id_{level}").isNotNull(), F.col(f"_{column}_{level}")
            ).otherwise(choice)
        return choice

    domain = winner("mapped_domain_id")
    outputs = {field.concept: concept_or_zero(winner("mapped_concept_id"), domain, field.domain)}
    if field.source:
        outputs[field.source] = concept_or_zero(winner("concept_id"))
    if field.mapped_domain:
        outputs[field.mapped_domain] = domain
    return found.withColumns(outputs).drop(
        *[f"_{c}_{level}" for c in columns for level in range(len(field.candidates))]
    )


def resolve_fields(df: DataFrame, book: Codebook | FieldBooks, fields: Sequence[CodedField]) -> DataFrame:
    for field in fields:
        df = resolve_field(df, book, field)
    return df


def resolve_fanout(df: DataFrame, books: Codebook | FieldBooks, prefix: str, how: str = "left") -> DataFrame:
    """One row per source row and standard target of its code, with the domains.

    With a left join, rows without a known code stay, with concept ids 0.
    """
    code, oid = code_columns(prefix)
    names = {
        "vocabulary_id": "vocabulary_id", "concept_id": "g_source_concept_id",
        "standard_concept": "standard_concept", "domain_id": "domain_id",
        "mapped_concept_id": "g_concept_id", "mapped_vocabulary_id": "mapped_vocabulary_id",
        "mapped_domain_id": "mapped_domain_id", "relationship_id": "relationship_id",
        "ordinal": "g_ordinal",
    }
    book = books.of_field(prefix)
    side = book.targets.select(
        F.col("oid").alias("_oid"), F.col("concept_code").alias("_code"),
        *[F.col(c).alias(out) for c, out in names.items()],
    )
    joined = df.join(
        small_in_bytes(side, book.target_bytes),
        (F.col(oid) == F.col("_oid")) & (F.col(code) == F.col("_code")), how,
    ).drop("_oid", "_code")
    if how == "left":
        joined = joined.withColumns({
            "g_source_concept_id": concept_or_zero("g_source_concept_id"),
            "g_concept_id": concept_or_zero("g_concept_id"),
        })
    return joined


def match_codes(df: DataFrame, coded: DataFrame, prefix: str, level: int = 1, row_id: str = "g_id") -> DataFrame:
    """Concepts matching a code, tagged with the level of the candidate."""
    code, oid = code_columns(prefix)
    wanted = df.filter(has_code(code, oid)).select(
        F.col(row_id), F.col(oid).alias("oid"), F.col(code).alias("concept_code")
    )
    return wanted.join(coded, ["oid", "concept_code"]).select(
        F.lit(level).alias("match_level"), row_id, F.lit(code).alias("code_field_name"),
        F.col("concept_code").alias("code"), "vocabulary_id", "concept_id",
        "standard_concept", "domain_id",
    )


def best_match(matches: DataFrame, row_id: str = "g_id") -> DataFrame:
    """The match of the lowest level per row; within a level the lowest concept."""
    ranked = Window.partitionBy(row_id).orderBy("match_level", "concept_id")
    return matches.withColumn("match_rank", F.row_number().over(ranked)).filter("match_rank = 1")


def used_pairs(df: DataFrame, prefixes: Sequence[str], source: str | None = None) -> DataFrame:
    """The distinct (oid, concept_code) pairs of some coded fields, in one scan; for each
    field apart, under a ``field`` column, if the staging table is named."""

    def pair(prefix: str):
        code, oid = code_columns(prefix)
        named = [F.lit(field_name(source, prefix)).alias("field")] if source else []
        return F.struct(*named, F.col(oid).alias("oid"), F.col(code).alias("concept_code"))

    pairs = F.array(*[pair(p) for p in prefixes])
    return (
        df.select(F.explode(pairs).alias("_pair")).select("_pair.*")
        .filter("oid is not null and concept_code is not null").distinct()
    )
