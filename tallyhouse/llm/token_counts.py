"""Token counts with a digest cache.

The cache is a table ``(version, digest, n_tokens)``. Texts are joined to it on the digest of
their content and the digest of the tokenizer file; only distinct texts that miss are encoded,
and their counts are appended. Content is normalised only as far as no count can change: a null
text is the empty text.

A group of copies of any size costs one encoded text: the copies are merged before the shuffle.
Repeated rows stay repeated rows of the result, a null ``doc_id`` stays null, very long texts are encoded whole, an
empty table gives an empty result and an empty cache. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm.common import map_batches, schema_of
from tallyhouse.session import materialise

CACHE_SCHEMA = "version string, digest string, n_tokens long"


@lru_cache
def tokenizer_version(model_path: str) -> str:
    with open(model_path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def read_cache(spark: SparkSession, cache_path: str) -> DataFrame:
    """The cache; empty where there is none yet. One that cannot be read is an error, not an empty cache."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def encode_counts(texts: DataFrame, model_path: str) -> DataFrame:
    """``(digest, n_tokens)`` of ``(digest, content)``; the library's defaults, nothing added."""

    def count(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for b in batches:
            yield {
                "digest": b["digest"],
                "n_tokens": [len(model.encode(t, num_threads=1)) for t in b["content"]],
            }

    return map_batches(texts, count, schema_of("digest string, n_tokens long"))


def count_tokens(
    docs: DataFrame, cache_path: str, model_path: str, limit: int = 4096,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row; misses are appended to ``cache_path``."""
    spark, version = docs.sparkSession, tokenizer_version(model_path)
    content = F.coalesce(F.col(text_col), F.lit(""))
    hashed = docs.select(
        F.col(id_col).alias("doc_id"), F.sha2(content, 256).alias("digest"), content.alias("content")
    )
    known = read_cache(spark, cache_path).where(F.col("version") == version).select("digest", "n_tokens")
    misses = hashed.select("digest", "content").dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    new = encode_counts(misses, model_path).select(F.lit(version).alias("version"), "digest", "n_tokens")
    new.write.mode("append").parquet(cache_path)

    # A run that was repeated after a lost driver may have appended a digest twice.
    # Written, so that both sides of the join are plain shuffles and Spark can split a hot digest.
    cached = read_cache(spark, cache_path).where(F.col("version") == version)
    counts = materialise(cached.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    rows = hashed.select("doc_id", "digest", F.octet_length("content").cast("long").alias("n_bytes"))
    return rows.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


