"""The operators of this package as queries on the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import alignment, decontaminate, hard_negatives, licenses, packing, quality, simhash, suffix_dedup, token_counts, toxicity, url_filter, vector_search, word_windows
from tallyhouse.session import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        keep_ids=False,
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.scan(docs, benchmark))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so every distinct text is encoded."""
    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"),
        new_folder(spark, "token_counts"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), list(url_filter.RULES))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.assign(_table(spark, sf_dir, "documents"))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats of the removed length, and beside them the bytes in shorter repeated passages."""
    return suffix_dedup.report(_table(spark, sf_dir, "documents"), shorter=suffix_dedup.PASSAGE)


def op8_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_windows.report(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op11_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search_embeddings(_table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_quality_rules,
        op2_packing,
        op3_decontamination,
        op4_token_counts,
        op5_url_filter,
        op6_simhash,
        op7_suffix_array,
        op8_word_windows,
        op9_toxicity,
        op10_license_scan,
        op11_vector_search,
        op12_token_alignment,
        op13_hard_negatives,
    )
    return {q.__name__: q for q in named}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality.SQL,
        "op3_decontamination": decontaminate.SQL,
        "op5_url_filter": url_filter.SQL,
        "op8_word_windows": word_windows.SQL,
        "op13_hard_negatives": hard_negatives.SQL,
    }
