"""A corpus pipeline: quality rules, one text of each near-duplicate group, decontamination, mixing, sharding.

Every stage takes nulls, empty and very long texts, repeated rows, empty tables and columns of any other name as its
operator does: null and empty texts fail the quality rules, so later stages see texts with words only; rows of one id
are judged each on its own; columns that documents has besides pass through all stages but the last.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from splicedf.llm import decontaminate, jaccard_join, kd_sharding, mixing, quality_rules
from splicedf.llm.common import drop_owned, owned, read, written

SHINGLE, SIMILAR = 5, (4, 5)
SHARD_BYTES = 64 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_only(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, k=SHINGLE, num=SIMILAR[0], den=SIMILAR[1])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every copy of the mix."""
    return kd_sharding.kd_shards(docs, target_bytes=SHARD_BYTES)


def after_others(stage: Stage) -> Stage:
    """The stage, which first deletes the scratch tables of the one before: by then that one's result is written."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_owned(spark, "stages")
        with owned("stages"):
            return stage(spark, docs, sf_dir)

    return run_stage


WORK = (("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontamination), ("source_mixing", mixture), ("kd_sharding", sharding))
STAGES = [(name, after_others(stage)) for name, stage in WORK]

#: The hashed multinomials of the first stage are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; a stage's scratch tables and its input go when its result is written."""
    docs, mine, last = read(spark, sf_dir, "documents"), uuid.uuid4().hex, None
    for name, stage in WORK[:-1]:
        with owned(mine):
            made = stage(spark, docs, sf_dir)
        with owned(mine + name):
            docs = written(made, name)
        drop_owned(spark, mine)
        if last:
            drop_owned(spark, mine + last)
        last = name
    return WORK[-1][1](spark, docs, sf_dir)
