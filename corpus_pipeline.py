"""The corpus pipeline: good documents, one of each group, without benchmark text, mixed, as token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.  All but the last
return the columns of ``docs``; ``run`` writes each result as Parquet into the shared work folder and
reads it back as the next one's ``docs``.

A rejected document goes in the first stage, all but the smallest doc_id of a near-duplicate group
(five-word shingles, similarity of 0.8 or more) in the second, a document with any benchmark window in the third; the fourth emits a document as often
as its source's rate says; the fifth writes the ids and reads an entry per document back.  An empty
table passes through every stage; nulls and other edge cases are those of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shiftlens.llm import decontaminate, mixing, neardup, quality, tokens
from shiftlens.llm.common import staged
from shiftlens.llm.queries import table, tokenizer


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs, NEAR)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.digest(docs, tokenizer("word_bpe_49k.json"), by_piece=True)


#: Least similarity in percent of the near copies that the second stage drops; op10_neardup has 85.
NEAR = 80

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good),
    ("neardup", distinct),
    ("decontaminate", clean),
    ("mixing", mixed),
    ("tokens", encoded),
]

#: SQL can't express the trained classifier, the sets of near copies or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
