"""The training-data pipeline: quality, near copies, repeated passages, benchmark text, packing.

Each stage gets the documents its predecessor kept and returns the columns of ``documents``; the last
one returns packed pieces. Documents a stage rejects are gone for the next one. Null and repeated rows
are treated as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import decontaminate, packing, quality, simhash, suffix_dedup
from tallyhouse.session import materialise

# Simhash components, suffix sorting and packing have no SQL form; tests/llm/test_pipeline.py
# compares all stages with brute force.
ORACLE_SQL = None

# Passages of more than 50 words are to go. In prose such a passage has at least about 270 bytes, so this many of
# them, some 45 words, must be found again elsewhere. Shorter repeats, as stock phrases and notices, stay.
PASSAGE_BYTES = 256


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    edited = suffix_dedup.remove_repeats(docs, length=PASSAGE_BYTES)
    return edited.withColumn("n_chars", F.length("text").cast("long"))


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        keep_ids=False,
    )


STAGES = [
    ("quality", quality_rules),
    ("simhash", near_duplicates),
    ("suffix_array", repeated_passages),
    ("decontamination", benchmark_text),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
