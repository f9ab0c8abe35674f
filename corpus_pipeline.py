"""A training corpus from raw documents: quality, near duplicates, repeated units, mixture, packed sequences.

Each stage gets the documents its predecessor kept, with all columns of ``documents``, and is written before the next
one reads it. Each handles nulls, empty texts, repeated rows and further columns as its operator says.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carestitch.llm.mixing import mix_sources
from carestitch.llm.near_duplicates import NearDuplicates, near_duplicates
from carestitch.llm.packing import pack_documents
from carestitch.llm.quality import fit_quality, score_quality
from carestitch.llm.scratch import cut
from carestitch.llm.units import remove_repeated_units


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it is fitted on these documents and the ``labels`` table."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = docs.columns
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), "text")
    return score_quality(work, model).where("predicted = 1").select(*[F.col("doc")[c].alias(c) for c in names])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str, rule: NearDuplicates = NearDuplicates()) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; rows without an id or words stay.

    Equal rows are one document. Different texts of one id are documents of their own: all stay, unless they are
    near duplicates.
    """
    found = cut(near_duplicates(docs, rule).where("doc_id is not null").select("doc_id", "version", "group"), "found")
    first = found.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "version")).alias("row")).select("row.*")
    kept = first.union(found.where("group is null").select("doc_id", "version").distinct())
    kept = cut(kept.select(F.col("doc_id").alias("n_id"), F.col("version").alias("n_version")), "kept")
    keyed = docs.withColumns({"n_row_id": F.col("doc_id").cast("long"), "n_row_version": F.xxhash64("text")})
    named = keyed.join(kept, (F.col("n_row_id") == F.col("n_id")) & (F.col("n_row_version") == F.col("n_version")), "left_semi")
    if found.groupBy("doc_id", "version").count().where("count > 1").limit(1).count():
        named = named.dropDuplicates(["n_row_id", "n_row_version"])
    return named.select(*docs.columns).union(docs.where("doc_id is null"))


def repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without units that occur earlier; ``n_chars`` follows the text."""
    done = remove_repeated_units(docs.withColumnRenamed("text", "raw"), text="raw")
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return done.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice. Texts without words are taken as their length is."""
    keyed = docs.withColumns({"m_id": F.col("doc_id").cast("long"), "m_version": F.xxhash64("text")})
    # Rows that can't be told apart are numbered on both sides; that costs a shuffle of the texts of its own.
    copies = keyed.groupBy("m_id", "m_version").count().where("count > 1").limit(1).count()
    number = F.row_number().over(Window.partitionBy("m_id", "m_version").orderBy("m_version")) if copies else F.lit(1)
    times = mix_sources(docs).select(F.col("doc_id").alias("m_id"), F.col("version").alias("m_version"), F.col("times").cast("int").alias("m_times"))
    taken = times.withColumn("m_copy", number).select(*[F.col(c).alias(f"t{c}") for c in ("m_id", "m_version", "m_copy", "m_times")])
    rows = keyed.withColumn("m_copy", number)
    same = F.col("m_id").eqNullSafe(F.col("tm_id")) & (F.col("m_version") == F.col("tm_version")) & (F.col("m_copy") == F.col("tm_copy"))
    return rows.join(taken.where("tm_times > 0"), same).withColumn("m_time", F.explode(F.sequence(F.lit(1), "tm_times"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their sequence, place and ids."""
    return pack_documents(docs)


#: The stage links texts from a similarity of 0.8 on; 0.85, the default of the rule, is that of the op6 query.
STAGES = [("quality", quality), ("near", partial(near, rule=NearDuplicates(percent=80))), ("repeated", repeated), ("mixture", mixture), ("pack", pack)]
#: No stage's rows can be had in SQL: tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
