"""From raw documents to packed training sequences: five stages, each one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read back as the next one's documents. All but the last return the
columns of documents. Learned scores and sketches have no SQL counterpart, so the
stages are tested against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderloom.llm.exact_dedup import without_copies
from orderloom.llm.mixing import mixed_rows
from orderloom.llm.near_dup import without_near_copies
from orderloom.llm.packing import pack
from orderloom.llm.tables import Scratch
from orderloom.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of what the stages keep of all documents."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, scratch.write(stage(spark, docs, sf_dir), name)
        if hasattr(before, "_scratch"):
            scratch.drop(before)
    return docs
