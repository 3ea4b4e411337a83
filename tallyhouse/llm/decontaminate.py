"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training texts.

Benchmark words are numbered; a document word outside that vocabulary is 0 and can be in no
window. Rolling hashes of the numbers find candidate windows, and every candidate is compared
word by word before it counts.

The benchmark goes out in blocks of a bounded number of words, one pass each, so the broadcast has
a size limit while any benchmark fits; hits of several blocks are merged per document. All blocks together stay
on the driver and the workers' disks, and each is one more scan: meant for benchmarks of up to some millions of words.

Empty cases: null and empty texts have no words and no hits; a null benchmark text has no
windows. An item with a null id marks words but is not listed. Repeated documents are judged
each; repeated items count once. An empty benchmark finds nothing, an empty document table gives an empty result.
Very long texts are scanned whole. Rows travel as structs, so that no column name of theirs can clash.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count, repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import letter_words, map_batches, schema_of
from tallyhouse.session import materialise

WINDOW = 13
# Words of one broadcast block: about 60 MB in a Python worker.
BLOCK_WORDS = 200_000
# Words scanned at once in a task.
CHUNK_WORDS = 400_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
SCANNED = "row long, doc_id long, n_words long, hits ints, items strings"


class Windows:
    """Hash set of the windows of one block of items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = defaultdict(set)
        for item_id, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in letter_words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if ids else 0):
                found[tuple(ids[i : i + size])].add(item_id)
        self.by_size: dict[int, tuple[np.ndarray, dict]] = {}
        for size in sorted({len(k) for k in found}):
            own = {k: v for k, v in found.items() if len(k) == size}
            hashes = _rolling(np.array([x for k in own for x in k], dtype=np.uint64), size)[::size]
            self.by_size[size] = np.unique(hashes), own

    def scan(self, ids: np.ndarray) -> list[tuple[int, int, set]]:
        """``(start, size, item ids)`` of every occurrence in a run of word numbers."""
        out = []
        known = ids != 0
        run = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(known, out=run[1:])
        for size, (hashes, windows) in self.by_size.items():
            if len(ids) < size:
                continue
            # Only windows without an unknown word can match.
            starts = np.flatnonzero(run[size:] - run[:-size] == size)
            if not len(starts):
                continue
            value = np.zeros(len(starts), dtype=np.uint64)
            for j in range(size):
                value = value * _BASE + ids[starts + j]
            place = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            for s in starts[hashes[place] == value].tolist():
                items = windows.get(tuple(ids[s : s + size].tolist()))
                if items is not None:
                    out.append((s, size, items))
        return out


def _rolling(ids: np.ndarray, size: int) -> np.ndarray:
    n = len(ids) - size + 1
    value = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        value = value * _BASE + ids[j : j + n]
    return value


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int):
    """Items in blocks of at most ``block_words`` words (or one item), streamed through the driver."""
    block, size = [], 0
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    for item, text in items.toLocalIterator():
        words = len(letter_words(text))
        if block and size + words > block_words:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += words
    yield block


def _scan_block(numbered: DataFrame, block: list[tuple], only_hits: bool = False) -> DataFrame:
    """Hit word positions and item ids of each document, or of those with hits, for one block."""
    shared = numbered.sparkSession.sparkContext.broadcast(block)

    def chunk(windows, rows, ids, lengths):
        ends = np.cumsum(lengths)
        begins = ends - lengths
        found = defaultdict(lambda: (set(), set()))
        for start, size, items in windows.scan(np.array(ids, dtype=np.uint64)):
            at = int(np.searchsorted(ends, start, side="right"))
            hits, named = found[at]
            hits.update(range(start - int(begins[at]), start - int(begins[at]) + size))
            named.update(i for i in items if i is not None)
        told = sorted(found) if only_hits else range(len(rows))
        return {
            "row": [rows[i][0] for i in told],
            "doc_id": [rows[i][1] for i in told],
            "n_words": [rows[i][2] for i in told],
            "hits": [sorted(found[i][0]) if i in found else [] for i in told],
            "items": [sorted(found[i][1]) if i in found else [] for i in told],
        }

    def run(batches):
        windows = Windows(shared.value)
        number = windows.numbers.get
        for b in batches:
            rows, ids, lengths = [], [], []
            for row, doc_id, text in zip(b["row"], b["doc_id"], b["text"]):
                words = letter_words(text)
                rows.append((row, doc_id, len(words)))
                # A 0 after each text keeps windows from crossing into the next one.
                ids.extend(map(number, words, repeat(0)))
                ids.append(0)
                lengths.append(len(words) + 1)
                if len(ids) > CHUNK_WORDS:
                    yield chunk(windows, rows, ids, np.array(lengths))
                    rows, ids, lengths = [], [], []
            if rows:
                yield chunk(windows, rows, ids, np.array(lengths))

    return map_batches(numbered, run, schema_of(SCANNED))


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, n_words, hits, items)`` per row of ``docs``: hit word positions and occurring items."""
    blocks = _blocks(benchmark, item_col, item_text_col, block_words)
    plain = docs.select(
        F.lit(None).cast("long").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _scan_block(plain, first).drop("row")
    # Repeated rows have equal ids, so each row gets a number of its own before the passes.
    numbered = materialise(plain.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    # The first pass tells every row's size; from the others only rows with hits come back.
    passes = _scan_block(numbered, first).unionByName(_scan_block(numbered, second, only_hits=True))
    for block in blocks:
        passes = passes.unionByName(_scan_block(numbered, block, only_hits=True))
    merged = passes.groupBy("row", "doc_id", "n_words").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.drop("row")


def report(scanned: DataFrame) -> DataFrame:
    """Digest columns of a scan: counts, the items' digest and the verdict."""
    n_hit = F.size("hits").cast("long")
    return scanned.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows; documents with fewer hits stay whole.

    Each row is judged by its own text, also where ids are null or repeat, so the rows get a number first.
    """
    row = F.monotonically_increasing_id().alias("row")
    rows = materialise(docs.select(row, F.struct("*").alias("doc")), "decontaminate-rows")
    scanned = scan(rows.select("row", F.col("doc")[text_col].alias("text")), benchmark, "row")
    bad = report(scanned).where("contaminated").select(F.col("doc_id").alias("row"))
    return rows.join(bad, "row", "left_anti").select("doc.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with the hit words cut out of the text; its other bytes and all other columns stay.

    Words are judged on the text as it was given, by every block.
    """
    rows = materialise(
        docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "decontaminate-rows"
    )
    given = rows.select("row", F.col("doc")[text_col].alias("text"))
    hit = scan(given, benchmark, "row", "text", item_col, item_text_col, block_words).where(F.size("hits") > 0)
    texts = given.join(hit.select(F.col("doc_id").alias("row"), "hits"), "row")

    def run(batches):
        for b in batches:
            yield {"row": b["row"], "new_text": [cut_words(t, set(h)) for t, h in zip(b["text"], b["hits"])]}

    cut = map_batches(texts, run, schema_of("row long, new_text string"))
    text = F.coalesce("new_text", F.col("doc")[text_col])
    return rows.join(cut, "row", "left").select(
        *[(text if c == text_col else F.col("doc")[c]).alias(c) for c in docs.columns]
    )


def cut_words(text: str, hit: set[int]) -> str:
    """A text without the words at these positions."""
    nth = count()
    return re.sub(rb"[0-9A-Za-z\x80-\xff]+", lambda m: b"" if next(nth) in hit else m[0], text.encode("utf-8", "replace")).decode()


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw USING (n, win)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
