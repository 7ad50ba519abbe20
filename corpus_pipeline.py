"""From raw documents to token ids: quality, near duplicates, repeated passages, benchmark leaks, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm import bpe, decontam, near_dup, quality, suffix_dedup
from reportloom.llm.common import read, staged
from reportloom.llm.registry import importable


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    importable(spark)
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates (five words, 0.8); documents without id go."""
    importable(spark)
    kept = near_dup.near_duplicates(docs, percent=80).filter("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings of 100 and more that also start earlier; n_chars follows the text."""
    importable(spark)
    cut = suffix_dedup.dedup(docs, keep_text=True).select("doc_id", F.col("kept_text").alias("text"))
    rest = docs.drop("text", "n_chars")
    joined = rest.join(cut, "doc_id").withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item to 0.8 or more."""
    leaks = decontam.contained_items(docs, read(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the text decoded from them."""
    importable(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", keep_one_of_each),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("byte_level_bpe", encode),
]

#: The classifier and the encoding are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read again for the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
