"""Harmonic packing of documents into sequences of a fixed capacity.

A document is cut into whole sequences and a tail. The tail is cut into lengths that are close
to a reciprocal share of the capacity: the largest ``capacity // k`` that fits comes off, until
what is left wastes little in a sequence of its class. Class ``k`` holds the lengths of which
``k`` fit and no more, and a sequence of the class takes exactly ``k`` of them.

Every task fills the sequences of its own documents; only the pieces of sequences that it could
not fill, fewer than ``k`` per class, go on. They are numbered per class over all tasks, from one
count per task and class, and fill sequences the same way. What then remains is less than one
sequence per class: a fixed bound that does not grow with the input. Those pieces are laid end to end,
cut at the capacity, and the last sequence is cut into powers of two, which need no padding.

Empty cases: a null or empty text is one piece, the end token. Repeated rows are packed as often
as they occur. An empty table gives no sequences. A null ``doc_id`` stays null.
"""

from __future__ import annotations

import base64
import zlib
from array import array

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm.common import map_batches, schema_of
from tallyhouse.session import materialise

CAPACITY = 2048
END_ID = 1
# A piece is not cut further when its sequence leaves at most this share of the capacity empty.
SLACK_DIVISOR = 128

# Splits text before the merges, as the byte-level tokenizer does; possessive, so it never backtracks.
_PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
# Other characters and special strings go to the reference library, which knows its own Unicode tables.
_UNUSUAL = "[^\t-\r -~\xa0-ɏ]|<[|]endoftext[|]>"

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PACKED = PIECE + ", k long, task long, nth long, sequence_id long, offset long"
PACKED_NAMES = [f.name for f in schema_of(PACKED)]
RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
# Sequence numbers: tasks use task * 2^32 + n, the later rounds their own ranges above.
CLASS_BASE, LAST_BASE = 1 << 61, 1 << 62


class Encoder:
    """Token ids as packed little-endian 32-bit integers, equal to the ``tokenizers`` file's.

    Plain texts take the faster library with the same merges; texts with unusual characters or
    special strings take ``tokenizers`` itself.
    """

    def __init__(self, json_path: str, ranks_path: str):
        import re

        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("plain", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(json_path)
        self.unusual = re.compile(_UNUSUAL)

    def ids(self, text: str | None) -> list[int]:
        text = text or ""
        if self.unusual.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def cut(length: int, capacity: int = CAPACITY) -> list[int]:
    """Piece lengths of a document of ``length`` tokens."""
    pieces = [capacity] * (length // capacity)
    left = length % capacity
    while left:
        if capacity % left <= capacity // SLACK_DIVISOR:
            pieces.append(left)
            break
        pieces.append(capacity // -(-capacity // left))
        left -= pieces[-1]
    return pieces


def fill_locally(pieces, task: int, capacity: int = CAPACITY):
    """Fill this task's sequences. Yields finished pieces; the ones left over have no sequence."""
    waiting: dict[int, list[tuple]] = {}
    sequences = 0
    for piece in pieces:
        k = capacity // piece[2]
        row = waiting.setdefault(k, [])
        row.append(piece)
        if len(row) == k:
            offset = 0
            for p in row:
                yield (*p, k, task, None, (task << 32) + sequences, offset)
                offset += p[2]
            sequences += 1
            row.clear()
    for k, row in sorted(waiting.items()):
        for nth, p in enumerate(row):
            yield (*p, k, task, nth, None, None)


def tokenised_pieces(docs: DataFrame, json_path: str, ranks_path: str, capacity: int, keep_ids: bool,
                     id_col: str, text_col: str) -> DataFrame:
    """Cut and locally packed pieces; runs where the documents are, without a shuffle."""
    def run(batches):
        task = TaskContext.get().partitionId()
        encoder = Encoder(json_path, ranks_path)

        def pieces():
            for b in batches:
                for doc_id, text in zip(b["doc_id"], b["text"]):
                    raw = array("I", [*encoder.ids(text), END_ID]).tobytes()
                    start, total = 0, len(raw) // 4
                    for n in cut(total, capacity):
                        part = raw[4 * start : 4 * (start + n)]
                        yield doc_id, start, n, zlib.crc32(part), total, part
                        start += n

        rows = []
        for row in fill_locally(pieces(), task, capacity):
            # Without keep_ids only pieces that may be cut once more need their ids.
            rows.append(row if keep_ids or row[9] is None else (*row[:5], None, *row[6:]))
            if len(rows) == 5000:
                yield dict(zip(PACKED_NAMES, zip(*rows)))
                rows = []
        if rows:
            yield dict(zip(PACKED_NAMES, zip(*rows)))

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(source, run, schema_of(PACKED))


def fill_by_class(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Number what the tasks left over per class and fill sequences of ``k``; the rest stays open."""
    counts = left.groupBy("k", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("k").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task and class, far fewer than pieces.
    firsts = counts.select(
        "k", "task",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.sum("n").over(Window.partitionBy("k")).alias("total"),
    )
    index = F.col("first") + F.col("nth")
    bin_ = F.floor(index / F.col("k"))
    full = (bin_ + 1) * F.col("k") <= F.col("total")
    base = F.lit(CLASS_BASE) + F.col("k") * F.lit(1 << 44)
    numbered = left.join(firsts, ["k", "task"]).withColumns(
        {"nth": index - bin_ * F.col("k"), "sequence_id": F.when(full, base + bin_)}
    )
    inside = Window.partitionBy("sequence_id").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    filled = numbered.where("sequence_id IS NOT NULL").withColumn(
        "offset", F.coalesce(F.sum("length").over(inside), F.lit(0))
    )
    return filled.select(*PACKED_NAMES), numbered.where("sequence_id IS NULL").select(*PACKED_NAMES)


def lay_end_to_end(rest: DataFrame, capacity: int, keep_ids: bool) -> DataFrame:
    """Pack the last open pieces, fewer than ``k`` per class ``k``, as one stream cut at the capacity."""

    def run(batches):
        rows = [r for b in batches for r in zip(*(b[n] for n in PACKED_NAMES))]
        ends = _sequence_ends(sum(r[2] for r in rows), capacity)
        out, sequence, offset = [], 0, 0
        for r in sorted(rows, key=lambda r: (-r[2], r[6:9])):
            doc_id, start, length, crc, total, ids = r[:6]
            done = 0
            while done < length:
                n = min(length - done, ends[sequence] - offset)
                part = ids[4 * done : 4 * (done + n)]
                out.append((doc_id, start + done, n, zlib.crc32(part), total, part if keep_ids else None,
                            r[6], r[7], None, LAST_BASE + sequence, offset))
                done, offset = done + n, offset + n
                if offset == ends[sequence]:
                    sequence, offset = sequence + 1, 0
        if out:
            yield dict(zip(PACKED_NAMES, zip(*out)))

    # A shuffle of the few open pieces; coalesce would pull the join before it into one task.
    return map_batches(rest.repartition(1), run, schema_of(PACKED))


def _sequence_ends(tokens: int, capacity: int) -> list[int]:
    """Fills of the last sequences: whole ones, then the binary digits of what remains."""
    left = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]


def pack(docs: DataFrame, json_path: str, ranks_path: str, capacity: int = CAPACITY, keep_ids: bool = True,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: document, start, length, checksum, ids, sequence and offset.

    ``ids`` (little-endian 32-bit integers) is null without ``keep_ids``.
    """
    pieces = materialise(
        tokenised_pieces(docs, json_path, ranks_path, capacity, keep_ids, id_col, text_col), "pack"
    )
    filled, rest = fill_by_class(pieces.where("sequence_id IS NULL"))
    last = lay_end_to_end(rest, capacity, keep_ids)
    wanted = [*RESULT, "ids"] if keep_ids else RESULT
    return (
        pieces.where("sequence_id IS NOT NULL").select(*wanted)
        .unionByName(filled.select(*wanted))
        .unionByName(last.select(*wanted))
    )

