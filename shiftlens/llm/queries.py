"""The registered queries opN_<name>: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shiftlens.llm import align, chat, decontaminate, merkle, mixing, neardup, neighbours, pivots, quality, repeats, sharding, tokens, warc


def tokenizer(name: str) -> str:
    """A vocabulary file of the public tokenizers."""
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    # this tokenizer drops white space, so pieces between spaces give the ids of the whole text
    return tokens.digest(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), by_piece=True)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(spark, table(spark, sf_dir, "conversations"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.digest(table(spark, sf_dir, "embeddings"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicated(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.grouped(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digest(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op13_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.linked(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_decontaminate": op2_decontaminate,
    "op3_tokens": op3_tokens,
    "op4_warc": op4_warc,
    "op5_chat": op5_chat,
    "op6_neighbours": op6_neighbours,
    "op7_repeats": op7_repeats,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_neardup": op10_neardup,
    "op11_alignment": op11_alignment,
    "op12_manifest": op12_manifest,
    "op13_pivots": op13_pivots,
}

SQL: dict[str, str] = {"op2_decontaminate": decontaminate.SQL, "op4_warc": warc.SQL, "op5_chat": chat.SQL, "op8_mixing": mixing.SQL, "op12_manifest": merkle.SQL}
