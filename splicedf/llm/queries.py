"""The queries of this subpackage: name to function of (spark, sf_dir), and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splicedf.llm import decontaminate, jaccard_join, kd_sharding, license_scan, mixing, pii, quality_rules, simplex_clusters, token_tables, toxicity, vector_codes, warc, weak_labels
from splicedf.llm.common import read, scratch
from splicedf.llm.oracles import ORACLE_SQL

#: Name of the tokenizer's file among the public tokenizers.
TOKENIZER, END_ID = "byte_bpe_50k.json", 2


def op1_token_tables(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    path = scratch(spark, "token-tables")
    token_tables.write_tables(read(spark, sf_dir, "documents"), path, tokenizer, END_ID)
    return token_tables.read_tables(spark, path).withColumnRenamed("_id", "doc_id")


def op2_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classified(read(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules.judged(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "gram_score")


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = kd_sharding.kd_shards(read(spark, sf_dir, "documents"), shards=16)
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licensed(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixing.with_copies(read(spark, sf_dir, "documents"))
    return d.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


def op9_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op10_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "archives")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).withColumnRenamed("_id", "doc_id")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, books = vector_codes.compressed(read(spark, sf_dir, "embeddings"))
    return d.select(F.col("_id").alias("vec_id"), "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def op13_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex_clusters.report(read(spark, sf_dir, "embeddings")).withColumnRenamed("_id", "vec_id").drop("compared")


QUERIES = {f.__name__: f for f in (op1_token_tables, op2_weak_labels, op3_jaccard_join, op4_decontamination, op5_quality_rules, op6_kd_sharding, op7_license_scan, op8_source_mixing, op9_pii_boosting, op10_warc_segments, op11_toxicity, op12_vector_codes, op13_simplex_clusters)}


__all__ = ["ORACLE_SQL", "QUERIES"]
