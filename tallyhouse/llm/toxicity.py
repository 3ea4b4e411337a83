"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features are the presence of lower-cased words, word pairs, and pairs with one word between,
hashed into ``2 ** HASH_BITS`` places. FTRL-proximal gives each place its own learning rate and L1
keeps all weights at zero that do not earn one, so the model is a short list that is broadcast.

The model is fitted on at most ``sample_rows`` labelled rows (a documented bound; which rows, a
hash of the id decides). They are dealt into shards of ``shard_rows``, each shard is fitted in a
task of its own, and the weights are averaged. Toxic rows are rare, so the bias is moved by the log of
the labels' ratio: the score is the chance of label 1 if both labels were equally frequent. All rows
are scored.

Empty cases: a text without words has the bias alone as its score, and an empty table gives an empty result.
A null ``doc_id`` is scored, is not held out and is never learned from. Very long texts are scored in a run of their own. Other columns
are not read. Labels that are null or whose
document is missing are not used, not even counted; a document labelled more than once is toxic if any label says
so. Of rows that repeat a labelled id the least text is learned from. Without labels the score is 0.5 for every text. Repeated rows are scored each.
"""

from __future__ import annotations

from math import exp, log

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import letter_words, map_batches, schema_of
from tallyhouse.session import materialise

HASH_BITS = 24
SAMPLE_ROWS, SHARD_ROWS = 40_000, 10_000
ALPHA, BETA, L1, L2, EPOCHS = 3.0, 1.0, 4.5, 0.1, 8
THRESHOLD = 0.7
# Texts are scored in runs of about this many words.
CHUNK_WORDS = 200_000
MAX_CACHED_WORDS = 200_000

_SHIFT = np.uint64(64 - HASH_BITS)
# Odd multipliers, one per kind of feature.
_ONE, _PAIR, _SKIP = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
BIAS = 0


class WordHashes:
    """64-bit hashes of words, remembered for frequent ones."""

    def __init__(self):
        from xxhash import xxh64_intdigest

        self.digest, self.known = xxh64_intdigest, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known, out = self.known, []
        for w in words:
            h = known.get(w)
            if h is None:
                if len(known) > MAX_CACHED_WORDS:
                    known.clear()
                h = known[w] = self.digest(w, 7)
            out.append(h)
        return np.array(out, dtype=np.uint64)


def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed places of the words, the pairs and the skip-pairs that begin at each position."""
    mix = lambda x: ((x ^ (x >> np.uint64(29))) * _PAIR) >> _SHIFT
    one = mix(hashes * _ONE)
    pair = mix(hashes[:-1] * _PAIR + hashes[1:] * _ONE) if len(hashes) > 1 else one[:0]
    skip = mix(hashes[:-2] * _SKIP + hashes[2:] * _ONE) if len(hashes) > 2 else one[:0]
    return one, pair, skip


def fit(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over ``(places, label)`` in the given order: places and weights that are not zero."""
    z, n = (np.zeros(1 << HASH_BITS, dtype=np.float32) for _ in range(2))
    weight = lambda i: np.where(
        np.abs(z[i]) <= L1, 0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
    )
    for _ in range(epochs):
        for at, label in examples:
            w = weight(at)
            error = _sigmoid(float(w.sum())) - label
            z[at] += error - (np.sqrt(n[at] + error * error) - np.sqrt(n[at])) / ALPHA * w
            n[at] += error * error
    at = np.flatnonzero(np.abs(z) > L1)
    return at, weight(at)


def _sigmoid(x: float) -> float:
    return 1 / (1 + exp(-max(-30.0, min(30.0, x))))


def example(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Distinct places of a text, the bias among them."""
    return np.unique(np.concatenate([np.array([BIAS], dtype=np.uint64), *places(hashes(letter_words(text)))])).astype(np.int64)


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, sample_rows: int = SAMPLE_ROWS,
          shard_rows: int = SHARD_ROWS) -> list[tuple[int, float]]:
    """Weights ``(place, weight)`` from labelled rows that ``held_out`` does not exclude.

    ``docs`` has ``doc_id, text``, ``labels`` has ``doc_id, toxic``.
    """
    known = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    labelled = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # Labels of missing documents must move neither the bias nor the number of shards.
    usable = materialise(labelled.join(known, "doc_id", "left_semi"), "labelled")
    rows, toxic = usable.agg(F.count("*"), F.count_if(F.col("toxic") > 0)).first()
    share = min(1.0, sample_rows / max(rows, 1))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
    shards = max(1, round(rows * share / shard_rows))
    # About sample_rows small rows, so sending them to all tasks is bounded; texts are not shuffled twice.
    sample = usable.where(draw < int(share * (1 << 30))).select(
        "doc_id", "toxic", draw.alias("order"), F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).alias("shard")
    )
    matched = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # Rows that repeat an id are one example, so that no id can fill a shard.
    chosen = matched.groupBy("doc_id", "toxic", "order", "shard").agg(F.min("text").alias("text"))

    def fit_shard(batches):
        shard_examples: dict[int, list] = {}
        hashes = WordHashes()
        for b in batches:
            for shard, text, toxic in zip(b["shard"], b["text"], b["toxic"]):
                shard_examples.setdefault(shard, []).append((example(text, hashes), toxic))
        for examples in shard_examples.values():
            at, w = fit(examples)
            yield {"place": at.tolist(), "weight": w.astype(float).tolist()}

    dealt = chosen.select("shard", "order", "text", "toxic").repartition(shards, "shard").sortWithinPartitions("shard", "order")
    fitted = map_batches(dealt, fit_shard, schema_of("place long, weight double"))
    model = fitted.groupBy("place").agg((F.sum("weight") / shards).alias("weight"))
    weights = dict(map(tuple, model.collect()))
    if 0 < toxic < rows:
        weights[BIAS] = weights.get(BIAS, 0.0) + log((rows - toxic) / toxic)
    return list(weights.items())


def score(docs: DataFrame, model: list[tuple[int, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` per row."""
    shared = docs.sparkSession.sparkContext.broadcast(sorted(model))

    def chunk(texts: list[list[bytes]], hashes: WordHashes, at: np.ndarray, w: np.ndarray, flag: np.ndarray) -> np.ndarray:
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        owner = np.repeat(np.arange(len(texts)), sizes)
        keys = []
        for reach, kind in enumerate(places(hashes([x for t in texts for x in t]))):
            i = np.flatnonzero(flag[kind])
            # A pair that begins in one text and ends in the next belongs to neither.
            i = i[owner[i] == owner[i + reach]] if reach else i
            keys.append(owner[i] * len(at) + np.searchsorted(at, kind[i]))
        distinct = np.unique(np.concatenate(keys))
        bias = float(w[0]) if len(at) and at[0] == BIAS else 0.0
        inside = distinct % max(len(at), 1)
        own = distinct[inside > 0] if bias else distinct
        total = np.bincount(own // max(len(at), 1), weights=w[own % max(len(at), 1)], minlength=len(texts)) if len(own) else 0.0
        return 1 / (1 + np.exp(-np.clip(total + np.full(len(texts), bias), -30, 30)))

    def run(batches):
        model = shared.value
        at = np.array([p for p, _ in model], dtype=np.uint64)
        w = np.array([x for _, x in model])
        flag = np.zeros(1 << HASH_BITS, dtype=bool)
        flag[at.astype(np.int64)] = True
        hashes = WordHashes()
        for b in batches:
            out, texts, words = [], [], 0
            for text in b["text"]:
                texts.append(letter_words(text))
                words += len(texts[-1])
                if words > CHUNK_WORDS:
                    out += chunk(texts, hashes, at, w, flag).tolist()
                    texts, words = [], 0
            if texts:
                out += chunk(texts, hashes, at, w, flag).tolist()
            yield {"doc_id": b["doc_id"], "score": out}

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(source, run, schema_of("doc_id long, score double"))


def is_held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``."""
    docs = docs.select("doc_id", "text")
    model = learn(docs, labels, is_held_out())
    return score(docs, model).select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
