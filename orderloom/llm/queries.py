"""One registered query per operator: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import lm_scoring
from orderloom.llm.chat import chat_digests, format_chats
from orderloom.llm.exact_dedup import exact_dedup
from orderloom.llm.hard_negatives import mine_negatives
from orderloom.llm.html_text import extract_text
from orderloom.llm.mixing import mix_documents
from orderloom.llm.near_dup import near_duplicates
from orderloom.llm.neighbours import nearest_neighbours
from orderloom.llm.packing import pack
from orderloom.llm.separator_scan import token_counts
from orderloom.llm.spelling import count_words, spelling_variants
from orderloom.llm.toxicity import learn, score_documents
from orderloom.llm.url_rules import judge_urls

Query = Callable[[SparkSession, str], DataFrame]

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# The conversation that the contract adds to the table.
ADDED_TURNS = tuple((-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant")))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_documents(docs, learn(docs, _table(spark, sf_dir, "labels")))


def op4_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_documents(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    added = spark.createDataFrame(ADDED_TURNS, "conv_id long, turn long, role string, text string")
    return chat_digests(format_chats(turns.unionByName(added)))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(count_words(_table(spark, sf_dir, "documents"), damage_every=199))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One label in seven is moved on, so that near vectors differ in label.
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        op1_exact_dedup,
        op2_html_extraction,
        op3_toxicity,
        op4_separator_scan,
        op5_best_fit_packing,
        op6_url_filters,
        op7_source_mixing,
        op8_chat_formatting,
        op9_near_duplicates,
        op10_nearest_neighbours,
        op11_spelling_variants,
        op12_lm_scoring,
        op13_hard_negatives,
    )
}
