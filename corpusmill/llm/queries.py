"""The dealt operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path

from .byte_bpe import byte_tokens
from .extraction import main_texts
from .fingerprints import fingerprints
from .lattice import score_texts
from .lexical import RANKED_SQL, ranked_documents
from .near_dedup import near_duplicates
from .packing import pack
from .passages import repeated_passages
from .quality import quality
from .spelling import spelling_variants
from .tables import table
from .toxicity import toxicity
from .topk import TOP_K_SQL, similar_vectors
from .warc import ARCHIVED_SQL, archived_pages, records, write_warc

Query = Callable[[SparkSession, str], DataFrame]


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_tokens(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(records(table(spark, sf_dir, "pages")), path)
    return archived_pages(spark, path)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), damage=True)


QUERIES: dict[str, Query] = {
    "op1_top_k": op1_top_k,
    "op2_near_dedup": op2_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_html_extraction": op4_html_extraction,
    "op5_quality": op5_quality,
    "op6_fingerprints": op6_fingerprints,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_lm_score": op8_lm_score,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_packing": op10_packing,
    "op11_warc": op11_warc,
    "op12_ranked_search": op12_ranked_search,
    "op13_spelling": op13_spelling,
}

SQL: dict[str, str] = {
    "op1_top_k": TOP_K_SQL,
    "op11_warc": ARCHIVED_SQL,
    "op12_ranked_search": RANKED_SQL,
}
