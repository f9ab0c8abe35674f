"""Key lookups and row alignment.

Broadcasts happen in two ways only: a side whose size was measured and lies below
``BROADCAST_ROWS`` or, for code lookups, ``BROADCAST_BYTES`` is hinted; any other side is left to Catalyst, which broadcasts below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with AQE splitting hot
partitions (``spark.sql.adaptive.skewJoin.enabled``). AQE can split a join only if both
inputs come straight from a shuffle, so sides are de-duplicated into a table of their own
(``key_table``) before the join rather than inside it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
# A table resolves up to a dozen fields in one plan, each with a lookup of its own.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, rows: int | None) -> DataFrame:
    """Broadcast a side of measured size; leave unmeasured or large sides alone."""
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df


def small_in_bytes(df: DataFrame, size: int | None) -> DataFrame:
    """Broadcast a side of measured bytes; leave unmeasured or large sides alone."""
    return F.broadcast(df) if size is not None and size <= BROADCAST_BYTES else df


def row_bytes(df: DataFrame) -> Column:
    """What a row takes in a broadcast side: a header, a word for each column, and the texts."""
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) + 8 for name, kind in df.dtypes if kind == "string"]
    return sum(texts, F.lit(24 + 8 * len(df.columns)).cast("long"))


def unique_by(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key: the smallest combination of the values (map-side combined)."""
    if not values:
        return df.select(*keys).distinct()
    if len(values) == 1:
        return df.groupBy(*keys).agg(F.min(values[0]).alias(values[0]))
    best = df.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def key_table(dim: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Natural key → surrogate of a dimension, one row per key. Materialise it when the
    dimension may be too large to broadcast."""
    return unique_by(dim.filter(F.col(keys[0]).isNotNull()), keys, [value])


def lookup(facts: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str],
           how: str = "left", unique: bool = False, dim_rows: int | None = None) -> DataFrame:
    """Attach dimension columns to facts by natural key, without multiplying facts.

    on      fact column → dimension key
    take    dimension column → output column
    unique  the dimension is known to have one row per key
    """
    keys = list(dict.fromkeys(on.values()))
    if not unique:
        dim = unique_by(dim.filter(F.col(keys[0]).isNotNull()), keys, list(take))
    side = dim.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(on.values())],
        *[F.col(c).alias(out) for c, out in take.items()],
    )
    condition = [F.col(f) == F.col(f"_key_{i}") for i, f in enumerate(on)]
    joined = facts.join(small(side, dim_rows), on=condition, how=how)
    return joined.drop(*[f"_key_{i}" for i in range(len(on))])


def lookup_value_code(facts: DataFrame, mapping: DataFrame, value: str, key: str,
                      when=None, mapping_rows: int | None = None) -> DataFrame:
    """Attach the codes a source value was mapped to; ``when`` limits which rows look up."""
    wanted = F.col(value) if when is None else F.when(when, F.col(value))
    side = mapping.withColumnRenamed(key, "_key")
    return (
        facts.withColumn("_wanted", wanted)
        .join(small(side, mapping_rows), F.col("_wanted") == F.col("_key"), "left")
        .drop("_wanted", "_key")
    )


def align_to_person(facts: DataFrame, person: DataFrame, unique: bool = False,
                    person_rows: int | None = None) -> DataFrame:
    """Keep rows of known persons and attach ``person_id``."""
    return lookup(facts, person, {"s_person_id": "person_source_value"},
                  {"person_id": "person_id"}, "inner", unique, person_rows)


def align_to_visit(facts: DataFrame, visit_link: DataFrame, how: str = "left",
                   unique: bool = False, visit_rows: int | None = None) -> DataFrame:
    """Attach ``visit_occurrence_id``; the encounter must belong to the same person."""
    return lookup(
        facts, visit_link,
        {"s_encounter_id": "s_encounter_id", "s_person_id": "s_person_id"},
        {"visit_occurrence_id": "visit_occurrence_id"}, how, unique, visit_rows,
    )


def _year_list(first: Column, last: Column) -> Column:
    """The years from first to last; none if they are the other way round."""
    return F.when(first <= last, F.sequence(first, last))


def payer_at_encounter(encounter: DataFrame, payer: DataFrame) -> DataFrame:
    """Pairs of encounter and payer period of one person where the encounter's end (or
    start) lies in the period; open periods never match.

    The range join runs as an equi-join on person and calendar year: a period is listed
    once per year it touches, an encounter falls in exactly one year, so every pair meets
    once and a person with very many rows is spread over the years. Only years in which
    encounters end are listed: an open-ended period (until 9999) has as many rows as those.
    """
    encounters = encounter.withColumn(
        "_at", F.coalesce("s_visit_end_datetime", "s_visit_start_datetime").try_cast("timestamp")
    ).withColumn("_year", F.year("_at"))
    bounds = encounters.agg(F.min("_year").alias("_first"), F.max("_year").alias("_last"))

    def years(side: str) -> Column:
        return bounds.select(side).scalar()

    periods = (
        payer.withColumnRenamed("s_person_id", "_payer_person_id")
        .withColumns({
            "_from": F.col("s_payer_start_datetime").try_cast("timestamp"),
            "_to": F.col("s_payer_end_datetime").try_cast("timestamp"),
        })
        .filter(F.col("_from") <= F.col("_to"))
        .withColumn("_payer_year", F.explode(_year_list(
            F.greatest(F.year("_from"), years("_first")), F.least(F.year("_to"), years("_last")))))
    )
    return encounters.join(
        periods,
        (F.col("s_person_id") == F.col("_payer_person_id"))
        & (F.col("_year") == F.col("_payer_year"))
        & F.col("_at").between(F.col("_from"), F.col("_to")),
    ).drop("_at", "_year", "_payer_person_id", "_from", "_to", "_payer_year")
