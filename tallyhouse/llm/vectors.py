"""What the vector operators share: which vectors take part, nearest centres, bounded groups, best rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.common import map_batches, schema_of
from tallyhouse.session import materialise

# Stands for a null id where rows are ordered, so that it comes last; no given id may have this value.
NO_ID = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """True for vectors of at least one component, all neither null nor infinite nor NaN."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def of_common_size(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows whose vectors have the most frequent number of components (of ties the largest), and it."""
    sizes = df.groupBy(F.size(vector).alias("size")).count()
    most = sizes.agg(F.max(F.struct("count", "size"))["size"]).first()[0]
    return (df.where(F.size(vector) == most), most) if most else (df, 0)


def pack(vectors: np.ndarray) -> list[bytes]:
    return [v.tobytes() for v in np.ascontiguousarray(vectors)]


def unpack(packed: list[bytes], dtype=np.float64) -> np.ndarray:
    """A matrix with one packed vector a row."""
    return np.frombuffer(b"".join(packed), dtype).reshape(len(packed), -1) if packed else np.zeros((0, 0), dtype)


def sample_of(df: DataFrame, rows: int, key: str = "row") -> DataFrame:
    """At most ``rows`` rows, the same ones at each run: those with the least hashes of ``key``."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)


def nearest(vectors: np.ndarray, centres: np.ndarray, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Per vector the place of the nearest centre and the distance to it."""
    at = np.zeros(len(vectors), dtype=np.int64)
    half = (centres**2).sum(axis=1) / 2
    for i in range(0, len(vectors), step):
        at[i : i + step] = np.argmin(half - vectors[i : i + step] @ centres.T, axis=1)
    return at, np.sqrt(((vectors - centres[at]) ** 2).sum(axis=1))


def bounded_groups(df: DataFrame, key: str, most: int) -> DataFrame:
    """``df`` with a column ``part`` that splits each value of ``key`` into groups of about ``most`` rows.

    The counts are one row per key, so they go along with a join that Spark sizes itself.
    """
    counts = df.groupBy(key).agg(F.ceil(F.count("*") / most).alias("parts"))
    return df.join(counts, key).withColumn("part", F.pmod(F.xxhash64("row"), "parts")).drop("parts")


def best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` best rows per ``by``: highest ``score``, then smallest ``id``; numbered in ``rank`` from 1.

    Spark keeps the best ``k`` of each task before it shuffles.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: highest score, then smallest id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)
    if k and len(scores) > 4 * k:
        few = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        few = np.arange(len(scores))
    return few[np.lexsort((ids[few], -scores[few]))[:k]]


def given_id(column: str) -> Column:
    """The id as given, null again where there was none."""
    return F.when(F.col(column) != NO_ID, F.col(column))


def placed(items: DataFrame, centres: np.ndarray, keep: str, label: str, prepare) -> DataFrame:
    """``items`` (packed in ``vector``) with the nearest centre and the distance to it, written once.

    ``prepare`` turns a matrix of packed vectors into the points that the centres lie among.
    """

    def run(batches):
        for b in batches:
            at, far = nearest(prepare(unpack(b["vector"])), centres) if b["vector"] else ([], [])
            yield b | {"centre": at, "far": far}

    return materialise(map_batches(items, run, schema_of(f"{keep}, vector binary, centre long, far double")), label)
