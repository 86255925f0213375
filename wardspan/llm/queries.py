"""The corpus operators over the given tables, and their answers in SQL where SQL has them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from wardspan.llm.chat import chat_digest, format_chats
from wardspan.llm.common import crc_of_id
from wardspan.llm.decontamination import mark_contamination
from wardspan.llm.fingerprints import compare_edits
from wardspan.llm.langid import fit, identify
from wardspan.llm.linededup import dedup_lines
from wardspan.llm.lm import score_texts
from wardspan.llm.merkle import check_documents
from wardspan.llm.mixing import mix
from wardspan.llm.neighbours import nearest
from wardspan.llm.oracle import ORACLE
from wardspan.llm.repair import damage, repair_report
from wardspan.llm.sharding import shard
from wardspan.llm.simhash import near_duplicates
from wardspan.llm.warc import page_digests, read_archive, write_archive
from wardspan.runtime import fresh_folder

ODD_CHAT = r"\### Assistant: </turn> ok"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = crc_of_id("doc_id") % 5 == 0
    model = fit(docs.filter(~held_out).select("text", "lang"))
    scored = identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return scored.select("doc_id", "held_out", "lang_pred", "score")


def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return score_texts(docs, crc_of_id("doc_id") % 10 == 0, keep=["doc_id"])


def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ODD_CHAT).alias("text"),
    )
    return chat_digest(format_chats(turns.unionByName(odd)))


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(_table(spark, folder, "documents").select("doc_id", "text", "source"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    marked = mark_contamination(docs, _table(spark, folder, "benchmark").select("item_id", "text"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "n_lines", "n_deleted", "deleted_words", F.sha2("text", 256).alias("text_sha256")
    )


def op8_simhash_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs, keep=["doc_id"]).select("doc_id", "fingerprint", "component_id")


def op9_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    archive = fresh_folder(spark, "warc")
    write_archive(pages, archive)
    return page_digests(read_archive(spark, archive))


def op10_ring_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return shard(docs, keep=["doc_id"])


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(damage(turns), turns)


def op12_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return compare_edits(_table(spark, folder, "documents").select("doc_id", "text"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return check_documents(_table(spark, folder, "documents"))


CORPUS_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_source_mixing": op5_source_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_line_dedup": op7_line_dedup,
    "op8_simhash_duplicates": op8_simhash_duplicates,
    "op9_warc_archive": op9_warc_archive,
    "op10_ring_sharding": op10_ring_sharding,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}
CORPUS_ORACLE: dict[str, str] = ORACLE | (
    {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
)
