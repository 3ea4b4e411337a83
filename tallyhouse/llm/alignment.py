"""Alignment of two tokenizers' ids over the same bytes, and how often their ids stand together.

Both id lists are turned into cumulative byte ends, which rise. Each end of one is looked up among the ends of
the other; those found are the offsets where tokens of both end. They slice both id lists into groups, and the links of a group are all its pairs of an id of one and an id of the
other tokenizer. A pair's count is the number of documents that hold it linked.

Documents are aligned where they are read, in blocks of a bounded number of bytes. A block is one
row: its documents' figures, its distinct pairs with the number of its documents that hold them, and per
document the places of its pairs in that list. Whoever writes, reads, sorts or passes on rows holds many of them, so
blocks are of some 2 MB of text, places and links take as few bytes a number as the block's largest needs (about
1 MB a row in all), row groups are small, and Python turns one block or a few documents at a time into its own values. Only the distinct pairs of a block are shuffled: once
summed to counts over all documents, once to bring the counts back to the blocks. Nothing is
broadcast, so the number of different pairs may grow with the documents.

Empty cases: a null or empty text, and one whose tokens do not give back exactly its bytes (as where a
tokenizer normalises), has no tokens, so all its figures are zero and its digest is the empty text. Very
long texts are one document of a block of their own. Repeated rows are documents each: they stay
repeated rows and count as often as they occur. Ids without a tie are the best of their kind; all pairs
that tie for the highest count are. A null ``doc_id`` stays null, other columns are not read, and an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import map_batches, schema_of
from tallyhouse.llm.packing import Encoder
from tallyhouse.session import materialise

# Bytes of text after which a block is closed.
BLOCK_BYTES = 2 << 20
# Documents that are Python values at once.
DOCUMENTS = 64
# Readers hold a row group at once. The writer looks at its size after so few rows, as they are large.
_GROUPS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 4}
# Links of a group that are listed one by one.
LISTED_LINKS = 4096

_FIGURES = "n_a longs, n_b longs, n_groups longs, n_links longs, groups_sha256 strings"
BLOCK = f"block long, doc_id longs, {_FIGURES}, n_pairs longs, place binary, times binary, pair longs, docs longs"
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
GROUPS = "doc_id long, a_ids ints, b_ids ints, a_ends ints, b_ends ints"


_NO_TOKENS = (np.zeros(0, dtype=np.int64),) * 4


class Aligner:
    """Encodes a text with both tokenizers and cuts the ids into groups.

    A is a byte-level file of ``tokenizers`` (with the same merges as ranks, which encode faster), B a
    model of ``sentencepiece``. Special tokens' strings inside a text are plain text.
    """

    def __init__(self, a_json: str, a_ranks: str, b_model: str):
        import sentencepiece

        self.a = Encoder(a_json, a_ranks)
        self.a.exact.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_model)
        printed = _printed_bytes()
        names = (self.a.exact.id_to_token(i) for i in range(self.a.exact.get_vocab_size()))
        self.a_bytes = [bytes(printed[c] for c in n) if n and all(c in printed for c in n) else None for n in names]
        self.names = [str(i) for i in range(max(len(self.a_bytes), self.b.get_piece_size()))]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(x or b"") for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both id lists, and where their groups end in each; all empty for a text without tokens."""
        whole = (" " + (text or "")).encode("utf-8", "replace")
        if len(whole) == 1:
            return _NO_TOKENS
        a, b = self.a.ids(" " + text), self.b.encode(text, num_threads=1)
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if None in a_parts or b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            return _NO_TOKENS
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        # No token is empty, so ends rise, and each end of A is looked up among those of B.
        a_at, b_at = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        place = np.searchsorted(b_at, a_at)
        shared = np.flatnonzero(b_at[place] == a_at)
        return a, b, shared + 1, place[shared] + 1

    def describe(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        out, i, j, names = [], 0, 0, self.names
        a, b = [names[x] for x in a.tolist()], [names[x] for x in b.tolist()]
        for k, m in zip(a_ends.tolist(), b_ends.tolist()):
            left = a[i] if k - i == 1 else ",".join(a[i:k])
            out.append(f"{left}|{b[j]}" if m - j == 1 else f"{left}|{','.join(b[j:m])}")
            i, j = k, m
        return ";".join(out)


@lru_cache(maxsize=1)
def _aligner(a_json: str, a_ranks: str, b_model: str) -> Aligner:
    """One per process: a worker that has a new one for each task keeps the memory of the old ones."""
    return Aligner(a_json, a_ranks, b_model)


def _printed_bytes() -> dict[str, int]:
    """Which character stands for which byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def link_pairs(a, b, a_ends, b_ends) -> tuple[np.ndarray, np.ndarray]:
    """The document's distinct linked pairs, packed as ``a << 32 | b``, and the links of each."""
    ids_a, ids_b, ends_a, ends_b = (np.asarray(x, dtype=np.int64) for x in (a, b, a_ends, b_ends))
    width_a, width_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
    links = width_a * width_b
    listed = links <= LISTED_LINKS
    n = links[listed]
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(width_b[listed], n)
    row, column = np.divmod(nth, wide)
    at_a = np.repeat((ends_a - width_a)[listed], n) + row
    at_b = np.repeat((ends_b - width_b)[listed], n) + column
    # Listed links count one each, so sorting the keys alone tells how often each occurs.
    found = np.sort(ids_a[at_a] << 32 | ids_b[at_b])
    first = _first(found)
    keys, times = [found[first]], [np.diff(first, append=len(found))]
    for g in np.flatnonzero(~listed):
        # Ids that repeat in a long group are multiplied, not listed, so it stays small.
        x, nx = np.unique(ids_a[ends_a[g] - width_a[g] : ends_a[g]], return_counts=True)
        y, ny = np.unique(ids_b[ends_b[g] - width_b[g] : ends_b[g]], return_counts=True)
        keys.append((x[:, None] << 32 | y[None, :]).ravel())
        times.append((nx[:, None] * ny[None, :]).ravel())
    return _total(np.concatenate(keys), np.concatenate(times)) if len(keys) > 1 else (keys[0], times[0])


def _first(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array begins."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, dtype=np.int64)


def _total(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    first = _first(keys)
    return keys[first], np.add.reduceat(amounts, first) if len(keys) else amounts


def _narrow(numbers: np.ndarray) -> bytes:
    """Numbers that are not negative, in as few bytes each as the largest needs."""
    return numbers.astype(np.min_scalar_type(numbers.max(initial=0))).tobytes()


def _widen(packed: bytes, count: int) -> np.ndarray:
    return np.frombuffer(packed, f"u{len(packed) // count}").astype(np.int64) if count else np.zeros(0, dtype=np.int64)


def align(docs: DataFrame, a_json: str, a_ranks: str, b_model: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(doc_id, a_ids, b_ids, a_ends, b_ends)``: the ids, and behind which of them each group ends."""

    def run(batches):
        aligner = _aligner(a_json, a_ranks, b_model)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                a, b, a_ends, b_ends = (x.tolist() for x in aligner.groups(text))
                yield {"doc_id": [doc_id], "a_ids": [a], "b_ids": [b], "a_ends": [a_ends], "b_ends": [b_ends]}

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(given, run, schema_of(GROUPS), DOCUMENTS)


def align_blocks(docs: DataFrame, a_json: str, a_ranks: str, b_model: str, id_col: str = "doc_id",
                 text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of documents, as ``BLOCK`` says."""

    def close(number: int, rows: list[tuple]) -> dict[str, list]:
        found, times = np.concatenate([r[6] for r in rows]), np.concatenate([r[7] for r in rows])
        pairs, place, docs_with = np.unique(found, return_inverse=True, return_counts=True)
        columns = [[r[k] for r in rows] for k in range(6)]
        packed = (_narrow(place), _narrow(times), pairs, docs_with)
        row = (number, *columns, [len(r[6]) for r in rows], *packed)
        return {f.name: [value] for f, value in zip(schema_of(BLOCK), row)}

    def run(batches):
        aligner = _aligner(a_json, a_ranks, b_model)
        number, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                cut = aligner.groups(text)
                pairs, times = link_pairs(*cut)
                digest = hashlib.sha256(aligner.describe(*cut).encode()).hexdigest() if len(cut[0]) else ""
                rows.append((doc_id, len(cut[0]), len(cut[1]), len(cut[2]), int(times.sum()), digest, pairs, times))
                size += len(text or "") + 64
                if size >= block_bytes:
                    yield close(number, rows)
                    number, rows, size = number + 1, [], 0
        if rows:
            yield close(number, rows)

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(given, run, schema_of(BLOCK), DOCUMENTS)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """``(block, nth, pair, docs)``: a block's distinct pairs, by their place in its list."""
    listed = F.posexplode(F.arrays_zip("pair", "docs")).alias("nth", "p")
    return blocks.select("block", listed).select("block", "nth", "p.pair", "p.docs")


def count_pairs(blocks: DataFrame) -> DataFrame:
    """``(pair, docs, best)``: in how many documents a pair is linked, and whether no pair of its A id has more."""
    counts = materialise(block_pairs(blocks).groupBy("pair").agg(F.sum("docs").alias("docs")), "pair-counts")
    a_id = F.shiftright("pair", 32)
    highest = counts.groupBy(a_id.alias("a_id")).agg(F.max("docs").alias("most"))
    ranked = counts.withColumn("a_id", a_id).join(highest, "a_id")
    return ranked.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def pair_counts(docs: DataFrame, a_json: str, a_ranks: str, b_model: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(a_id, b_id, docs, best)``: the linked id pairs of all documents, as a translation table."""
    blocks = materialise(align_blocks(docs, a_json, a_ranks, b_model, id_col, text_col), "aligned", **_GROUPS)
    a_id, b_id = F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("b_id")
    return count_pairs(blocks).select(a_id, b_id, "docs", "best")


def report(docs: DataFrame, a_json: str, a_ranks: str, b_model: str, id_col: str = "doc_id",
           text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row of ``docs``."""
    blocks = materialise(align_blocks(docs, a_json, a_ranks, b_model, id_col, text_col, block_bytes), "aligned", **_GROUPS)
    # Written, so that both sides of the join are plain shuffles and Spark can split a pair that most blocks hold.
    counts = materialise(count_pairs(blocks), "ranked-pairs")
    ranked = block_pairs(blocks).select("block", "nth", "pair").join(counts, "pair")
    per_block = ranked.groupBy("block").agg(F.collect_list(F.struct("nth", "docs", "best")).alias("c"))
    told = blocks.drop("pair", "docs").join(per_block, "block", "left")
    figures = [n for n in blocks.columns if n not in ("block", "pair", "docs")]
    return map_batches(
        told.select(*figures, "c.nth", "c.docs", "c.best"), _sum_blocks, schema_of(RESULT), 1
    )


def _sum_blocks(batches):
    for batch in batches:
        for k in range(len(batch["doc_id"])):
            block = {name: column[k] for name, column in batch.items()}
            place, times = (_widen(block[name], sum(block["n_pairs"])) for name in ("place", "times"))
            nth = np.array(block["nth"] or [], dtype=np.int64)
            docs, best = np.zeros(len(nth), dtype=np.int64), np.zeros(len(nth), dtype=np.int64)
            docs[nth], best[nth] = block["docs"] or [], block["best"] or []
            ends = np.cumsum(block["n_pairs"])
            sums = [np.r_[0, np.cumsum(x[place] * times)] for x in (best, docs)]
            n_best, count_sum = (s[ends] - s[ends - block["n_pairs"]] for s in sums)
            same = {n: block[n] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            yield same | {"n_best": n_best, "count_sum": count_sum}
