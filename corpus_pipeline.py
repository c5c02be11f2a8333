"""From raw documents to packed training sequences, in five stages.

Each stage takes all rows its predecessor kept and is written as Parquet in the
shared folder before the next one reads it, so a lost executor costs the tasks
it ran and no earlier stage.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gablework.llm import line_dedup, minhash, packing, quality_rules, toxicity
from gablework.llm.common import prepared, vocabulary
from gablework.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    prepared(spark)
    return quality_rules.keep_good(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar, learned on labelled ones among them, does not find toxic."""
    labels = prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, labels)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of three-line windows; n_chars follows the text."""
    prepared(spark)
    return line_dedup.drop_repeated(docs).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    prepared(spark)
    return minhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of what is left, in sequences: a row per piece."""
    prepared(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("toxicity", clean),
    ("line_dedup", lines),
    ("near_dedup", distinct),
    ("packing", packed),
]

#: Tokens, learned weights and sampled signatures can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
