"""Registered queries of the corpus operators, with production parameters, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import (
    byte_bpe,
    hard_negatives,
    lexical,
    line_dedup,
    minhash,
    neighbours,
    packing,
    quality,
    simhash,
    substring_dedup,
    token_files,
    top_k,
    toxicity,
)
from cadastra.llm.common import table, written

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[run.__name__] = run
    return run


@query
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector."""
    return neighbours.search(neighbours.usable(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that at least three documents share, dropped from all but one."""
    return line_dedup.digests(table(spark, sf_dir, "documents"))


LLM_ORACLES["op2_line_dedup"] = line_dedup.ORACLE


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest integer inner products of every hundredth vector."""
    return top_k.search(top_k.integer_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


LLM_ORACLES["op4_exact_top_k"] = top_k.ORACLE


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document."""
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 1024 tokens."""
    pieces = written(packing.cut(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
    return packing.pack(pieces)


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that an earlier document has too."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles are 85 % alike."""
    return minhash.groups(table(spark, sf_dir, "documents"), minhash.Near(size=3, percent=85))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded by ranks and decoded again."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files with Elias-Fano boundaries, written and read back."""
    files = written(token_files.blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
    return token_files.read(files)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector: rows of other labels that score nearly as high as its positives."""
    return hard_negatives.mine(hard_negatives.usable(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


LLM_ORACLES["op11_hard_negatives"] = hard_negatives.ORACLE


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_ORACLES["op12_lexical_search"] = lexical.ORACLE


@query
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints differ in three bits at most."""
    return simhash.groups(table(spark, sf_dir, "documents"))
