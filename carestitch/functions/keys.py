"""Row identity: hashes for natural keys, and surrogate keys that survive a re-run.

A surrogate key has to be unique, the same on every run and on every retry of a lost
task, and must not need a global sort. ``add_row_id`` numbers rows inside 2**20 hash
buckets; ``fact_id`` derives the key of a fanned-out fact arithmetically, without a
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 20
# A fact key is (row id, ordinal of the target within the row's code, contributing table).
FANOUT_BITS = 10
SOURCE_BITS = 3
STAGED_ID = "_staged_id"


def location_key(*parts: Column | str) -> Column:
    """sha1 over the parts, nulls as empty text, no separator."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha1(F.concat(*[F.coalesce(c, F.lit("")) for c in cols]))


def stable_id(salt: str, value: Column | str) -> Column:
    """Salted 64-bit key; a null value keeps a null key."""
    col = F.col(value) if isinstance(value, str) else value
    return F.when(col.isNotNull(), F.xxhash64(F.concat(F.lit(salt), col)))


def person_key(salt: str, origin: Column | str) -> Column:
    """Salted person identifier of a document folder, as hex text."""
    col = F.col(origin) if isinstance(origin, str) else origin
    return F.sha2(F.concat(F.lit(salt), col), 256)


def composite_id(*parts: Column | str) -> Column:
    """Parts joined by two pipes; null as soon as one part is null."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    spaced = [cols[0]]
    for col in cols[1:]:
        spaced += [F.lit("||"), col]
    return F.concat(*spaced)


def add_row_id(df: DataFrame, keys: Sequence[str] | None = None, out: str = "g_id") -> DataFrame:
    """Unique positive 64-bit id per row, the same on every run over the same rows.

    ``keys`` (all columns by default) must be unique. The rows are hashed into buckets, so
    no bucket is hot even if single columns are, and numbered inside their bucket. The
    number is a rank: ids hold within one staging run, and more rows may change them. So a
    run replaces whole tables (``sinks.parquet.write_staged``).
    """
    keys = list(keys or df.columns)
    return _numbered(_bucketed(df, keys), keys, out)


def _bucketed(df: DataFrame, keys: list[str]) -> DataFrame:
    row_hash = F.xxhash64(*keys)
    return df.withColumns({"_bucket": F.pmod(row_hash, F.lit(1 << BUCKET_BITS)), "_hash": row_hash})


def _numbered(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    inside = Window.partitionBy("_bucket").orderBy("_hash", *keys)
    return (
        df.withColumn(out, F.shiftleft((F.row_number().over(inside) - 1).cast("bigint"), BUCKET_BITS) + F.col("_bucket"))
        .drop("_bucket", "_hash")
    )


def wave_of(keys: Sequence[str], waves: int) -> Column:
    """Which of ``waves`` (a power of two, ``2 ** BUCKET_BITS`` at most) a row is in: whole buckets of ``add_row_id``, so
    that the rows of a wave get the ids there that they get among all rows."""
    return F.pmod(F.xxhash64(*keys), F.lit(waves))


def distinct_with_row_id(df: DataFrame, out: str = "g_id") -> DataFrame:
    """Distinct rows, each with a surrogate id.

    Rows are dealt out by their bucket once; that also brings equal rows together, so the
    distinct and the numbering need no exchange of their own.
    """
    keys = df.columns
    dealt = _bucketed(df, keys).repartition("_bucket")
    return _numbered(dealt.dropDuplicates(["_bucket", "_hash", *keys]), keys, out)


def staged_id(df: DataFrame) -> str:
    """The column with the id of the staging row: ``g_id``, or what ``with_small_ids`` kept of it."""
    return STAGED_ID if STAGED_ID in df.columns else "g_id"


def fanout_bits(max_ordinal: int) -> int:
    """Bits for the ordinal of a target in a run whose widest code has that many besides the first."""
    return max(FANOUT_BITS, int(max_ordinal).bit_length())


def with_small_ids(df: DataFrame, bits: int = FANOUT_BITS) -> DataFrame:
    """Ids of foreign staging runs may be too large for fact keys; such rows are numbered anew,
    and their staging id is kept beside the number (``staged_id``) for lineage."""
    largest = df.agg(F.max("g_id")).first()[0] or 0
    if largest < 1 << (63 - bits - SOURCE_BITS):
        return df
    return add_row_id(df.withColumnRenamed("g_id", STAGED_ID), [STAGED_ID])


def fact_id(row_id: Column | str, ordinal: Column | int = 0, contributor: int = 0, bits: int = FANOUT_BITS) -> Column:
    """Key of one fact: unique across rows, across the targets of a row, and across the
    contributing tables, as long as the ordinal fits ``bits`` (see ``fanout_bits``) and the
    row id the bits that are left (see ``with_small_ids``).
    """
    row = F.col(row_id) if isinstance(row_id, str) else row_id
    nth = F.lit(ordinal) if isinstance(ordinal, int) else F.coalesce(ordinal, F.lit(0))
    return (
        F.shiftleft(row.cast("bigint"), bits + SOURCE_BITS)
        + F.shiftleft(nth.cast("bigint"), SOURCE_BITS)
        + F.lit(contributor).cast("bigint")
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that more than one row carries, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
