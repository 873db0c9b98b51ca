"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, embed_dedup, exact_dedup, filter_audit, hard_negatives, language, licenses, mixing, pii, quality,
               simhash, substring_dedup, url_filter)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_classes(table(spark, sf_dir, "embeddings"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs).select(
        "doc_id", F.expr("octet_length(coded.ids) div 4").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"), F.sha2("coded.decoded", 256).alias("decoded_sha256"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).drop("url")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "licenses.*").drop("spans")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs).select("doc_id", "pii.*").drop("redacted")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.draws(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_audit.masked(table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.counted(rows, table(spark, sf_dir, "labels")))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.predict(docs).select("doc_id", "held_out", "lang_pred", "score")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_embedding_near_dedup, op2_byte_bpe, op3_url_filters, op4_quality_classifier, op5_license_scan,
                        op6_simhash, op7_pii, op8_exact_dedup, op9_mixing, op10_substring_dedup,
                        op11_hard_negatives, op12_filter_audit, op13_language_id)
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": embed_dedup.ORACLE,
    "op3_url_filters": url_filter.ORACLE,
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
}
