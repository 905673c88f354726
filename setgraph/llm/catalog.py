"""Registered queries: each operator over its whole table, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import format_conversations, read_back
from .common import read
from .decontaminate import contaminations
from .hard_negatives import hard_negatives
from .langid import identify_languages
from .line_dedup import dedup_lines
from .minhash import near_duplicates
from .mixing import mix_sources
from .periodic_runs import periodic_runs
from .quality import quality
from .secret_scan import scan_secrets
from .sentencepiece import encode_texts
from .sharding import shard_by_bytes
from .toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]

# A conversation that says the template's own control strings.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(read(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(rows.unionByName(probe)))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(read(spark, sf_dir, "documents"), planted=True)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_line_dedup,
        op2_quality_rules,
        op3_toxicity,
        op4_minhash_near_dedup,
        op5_decontamination,
        op6_sentencepiece,
        op7_sharding,
        op8_language_id,
        op9_secret_scan,
        op10_chat_format,
        op11_mixing,
        op12_periodic_runs,
        op13_hard_negatives,
    )
}
