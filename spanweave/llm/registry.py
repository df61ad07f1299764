"""The registered queries of the text operators and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanweave.llm import (
    collocations,
    exact_copies,
    hard_negatives,
    importance,
    katz,
    licences,
    mixing,
    near_copies,
    outliers,
    revisits,
    sentencepieces,
    shards,
    token_files,
)
from spanweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_and_check(table(spark, sf_dir, "documents"), sentencepieces.public_model())


def op2_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        return token_files.query(spark, table(spark, sf_dir, "documents"), file.read())


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mark_copies(table(spark, sf_dir, "documents"))


def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.mark_near_copies(table(spark, sf_dir, "documents"))


def op8_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.mark_copies(table(spark, sf_dir, "documents"))


def op9_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents"))


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.query(spark, sf_dir)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.query(table(spark, sf_dir, "embeddings"))


def op13_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_sentencepieces, op2_importance, op3_katz, op4_token_files, op5_sharding, op6_mixing, op7_near_copies,
        op8_exact_copies, op9_outliers, op10_revisits, op11_collocations, op12_hard_negatives,
        op13_licences,
    )
}

ORACLE: dict[str, str] = {
    "op5_sharding": shards.SQL,
    "op6_mixing": mixing.SQL,
    "op8_exact_copies": exact_copies.SQL,
    "op10_revisits": revisits.SQL,
    "op11_collocations": collocations.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_licences": licences.SQL,
}
