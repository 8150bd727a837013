"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from placeledger.llm.alignment import alignment_digests
from placeledger.llm.byte_bpe import bpe_digests
from placeledger.llm.decontaminate import contained_items
from placeledger.llm.langid import identify_languages
from placeledger.llm.lm import score_texts
from placeledger.llm.manifest import manifest
from placeledger.llm.packing import piece_digests
from placeledger.llm.preferences import preference_digests
from placeledger.llm.shards import shard_digests
from placeledger.llm.simhash import simhash_components
from placeledger.llm.token_file import token_digests
from placeledger.llm.toxicity import classify_toxicity
from placeledger.llm.vectors import vector_components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


@query
def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with a stale last reply: the table has no judged pairs."""
    return preference_digests(table(spark, sf_dir, "conversations"))


@query
def op3_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digests(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))


@query
def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


@query
def op7_vector_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_components(table(spark, sf_dir, "embeddings"))


@query
def op8_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digests(table(spark, sf_dir, "documents"))


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
