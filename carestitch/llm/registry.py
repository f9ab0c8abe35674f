"""The operators as registered queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, hard_negatives, pivot_search, spelling
from .fingerprints import document_fingerprints
from .hamming_index import nearest
from .mixing import mix_sources
from .near_duplicates import near_duplicates
from .packing import pack_documents
from .quality import fit_quality, held_out, score_quality
from .suffixes import repeated_bytes
from .training_order import order_digests
from .units import remove_repeated_units


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_budgeted_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    return chat.conversation_digests(chat.chat_windows(chat.hostile_conversation(_table(spark, folder, "conversations"))))


def op2_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(_table(spark, folder, "embeddings"))


def op3_subset_sum_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_training_order(spark: SparkSession, folder: str) -> DataFrame:
    return order_digests(_table(spark, folder, "documents"))


def op5_line_hashing(spark: SparkSession, folder: str) -> DataFrame:
    done = remove_repeated_units(_table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.col("kept_text").alias("text"), "n_units", "n_removed", "kept", "removed")


def op6_superminhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op7_pu_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, _table(spark, folder, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return document_fingerprints(_table(spark, folder, "documents"))


def op9_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_bytes(_table(spark, folder, "documents")).drop("removed")


def op10_cost_balanced_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_table(spark, folder, "documents"), keep_ids=False)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, folder, "documents"))


def op12_four_russians_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.relabelled(_table(spark, folder, "embeddings")))


def op13_pivot_table_search(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_search.top_k(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_budgeted_chat_windows": op1_budgeted_chat_windows,
    "op2_multi_index_hashing": op2_multi_index_hashing,
    "op3_subset_sum_mixing": op3_subset_sum_mixing,
    "op4_training_order": op4_training_order,
    "op5_line_hashing": op5_line_hashing,
    "op6_superminhash_near_duplicates": op6_superminhash_near_duplicates,
    "op7_pu_quality_classifier": op7_pu_quality_classifier,
    "op8_imatch_fingerprints": op8_imatch_fingerprints,
    "op9_suffix_repeats": op9_suffix_repeats,
    "op10_cost_balanced_packing": op10_cost_balanced_packing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_four_russians_negatives": op12_four_russians_negatives,
    "op13_pivot_table_search": op13_pivot_table_search,
}
ORACLES: dict[str, str] = {
    "op1_budgeted_chat_windows": chat.SQL,
    "op11_spelling_variants": spelling.SQL,
    "op12_four_russians_negatives": hard_negatives.SQL,
    "op13_pivot_table_search": pivot_search.SQL,
}
