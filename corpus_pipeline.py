"""A corpus pipeline of five stages; each reads what the stage before it wrote.

Toxic documents, exact copies, near copies and documents with benchmark passages go; what stays is encoded. All stages but
the last return the columns of ``documents`` as they came, whatever their names and types.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import bpe, decontaminate, exact_dedup, minmax_dedup, toxicity
from tagloom.llm.shared import stored

#: Near copies share at least so many hundredths of their five-word shingles.
NEAR_PERCENT = 80
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minmax_dedup.drop_near_copies(docs, percent=NEAR_PERCENT)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trips(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_exact_copies),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_contaminated),
    ("encoding", encode),
]

#: Learned scores and token ids are beyond SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
