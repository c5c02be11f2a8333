"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from gablework.llm import (
    alignment,
    chat,
    factors,
    graphs,
    language_models,
    line_dedup,
    minhash,
    packing,
    pieces,
    quality_rules,
    ranked_bytes,
    toxicity,
    whitening,
)
from gablework.llm.common import prepared, vocabulary

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


WORDS, PIECES, BYTES = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"


def op1_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "n_chars")
    return factors.report(docs, _labels(spark, sf_dir))


def op2_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(_documents(spark, sf_dir), vocabulary(WORDS))


def op3_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(_conversations(spark, sf_dir))


def op4_distinct_chunk_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(_documents(spark, sf_dir), vocabulary(PIECES))


def op5_clause_grammar_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return toxicity.report_scores(docs, _labels(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(_documents(spark, sf_dir))


def op7_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(_documents(spark, sf_dir).select("doc_id", "text"))


def op8_layered_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.classes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_ranked_byte_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_bytes.report(_documents(spark, sf_dir), vocabulary(WORDS))


def op10_window_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_documents(spark, sf_dir))


def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_halving_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(_documents(spark, sf_dir).select("doc_id", "text"), vocabulary(BYTES), vocabulary(PIECES))


def op13_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_models.report(_documents(spark, sf_dir).select("doc_id", "text", "lang"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepared(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {
    q.__name__: _configured(q)
    for q in (
        op1_factorisation_quality,
        op2_hierarchical_packing,
        op3_snapshot_collapse,
        op4_distinct_chunk_pieces,
        op5_clause_grammar_toxicity,
        op6_quality_rules,
        op7_weighted_minhash,
        op8_layered_graphs,
        op9_ranked_byte_ids,
        op10_window_line_dedup,
        op11_chebyshev_whitening,
        op12_halving_alignment,
        op13_kneser_ney_language,
        pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op3_snapshot_collapse": chat.RENDER_SQL,
    "op6_quality_rules": quality_rules.report_sql(),
    "op10_window_line_dedup": line_dedup.REPORT_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
