"""Corpus pipeline: stages over the documents table, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arrears.llm import bpe, mixing, pii, quality, simhash
from arrears.llm.common import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality classifier rejects go."""
    return quality.keep_good(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group that links of four or fewer differing fingerprint bits connect."""
    return simhash.keep_one_per_group(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to surrogates; n_chars follows the text."""
    return pii.surrogates(docs, pii.DEFAULT_KEY).drop("__counts")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as it takes them, some more than once, some not at all."""
    return mixing.repeated(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix, and digests of ids and decoded text."""
    return bpe.tokenized(docs, public_tokenizers.path("word_bpe_49k.json"), ids=True).drop("decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("near-dedup", one_of_near_duplicates),
    ("personal data", without_personal_data),
    ("source mix", mixed_sources),
    ("bpe", encoded),
]

#: the stages train, search, encrypt and tokenize: no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what each keeps is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
