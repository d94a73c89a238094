"""The named queries of this subpackage and their DuckDB twins, merged by ``__spark_entry__``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from arrears.llm import (
    bpe, conversations, line_rules, mixing, pii, quality, repeats, resample, sharding, simhash, token_files, toxicity, vectors,
)
from arrears.llm.common import table
from arrears.sources.staging import fresh_path


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenized(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.DEFAULT_KEY)
    counts = F.coalesce(F.col("__counts"), F.create_map().cast("map<string,int>"))
    return out.select(
        "doc_id",
        "text",
        F.aggregate(F.map_values(counts), F.lit(0), lambda a, n: a + n).alias("n_entities"),
        *[F.coalesce(F.try_element_at(counts, F.lit(k)), F.lit(0)).alias(f"n_{k}") for k in pii.KINDS],
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicated(table(spark, sf_dir, "documents"))


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(table(spark, sf_dir, "documents"))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), 24, fresh_path(spark, "slot-map"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_positions(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_bpe": op2_bpe,
    "op3_mixing": op3_mixing,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_repeats": op6_repeats,
    "op7_line_rules": op7_line_rules,
    "op8_vectors": op8_vectors,
    "op9_quality": op9_quality,
    "op10_sharding": op10_sharding,
    "op11_conversations": op11_conversations,
    "op12_token_files": op12_token_files,
    "op13_resample": op13_resample,
}

ORACLES: dict[str, str] = {"op7_line_rules": line_rules.ORACLE}
