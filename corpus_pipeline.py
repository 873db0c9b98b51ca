"""Corpus preparation: a fixed order of stages over ``documents``.

Quality classifier (rejected documents go), exact dedup, SimHash near-dedup (one
document of each group stays), mixing sources to target weights (documents come
as often as they are drawn), byte-level BPE.  Every stage works on all its
predecessor kept and returns the columns of ``documents``; the last adds the
token ids, their number and whether they decode to the text.

Defined cases: a null text counts as empty and stays null; empty texts are scored
like others, are equal to each other, and have no words, so the mix takes none; a
null source is a source, last in order; rows with null ids are kept apart by
their texts and numbers; repeated rows are equal texts, of which one stays; very
long texts pass whole; an empty table gives an empty result.  Further columns of
``documents`` pass through under their names, whatever these are, and the added
columns get underscores where a name is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patrolspark.llm import bpe, exact_dedup, mixing, quality, simhash
from patrolspark.llm.common import col, free_name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, labels)
    return scored.where(col(scored, free_name(docs, "predicted")) == 1).select(*[col(scored, c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs, "__coded")
    out = bpe.round_trip(docs, out=name)
    coded = col(out, name)
    text = F.coalesce(col(out, "text"), F.lit("")).cast("binary")
    return out.select(
        *[col(out, c) for c in docs.columns], coded["ids"].alias(free_name(docs, "ids")),
        F.floor(F.octet_length(coded["ids"]) / 4).cast("int").alias(free_name(docs, "n_tokens")),
        (coded["decoded"] == text).alias(free_name(docs, "round_trip")))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte bpe", tokenize),
]

#: The classifier, fingerprints and token ids have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
