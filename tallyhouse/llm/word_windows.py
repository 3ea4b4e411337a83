"""Repeated word windows by level-wise doubling, at most one entry per window and task sent on.

A level looks for windows that occur in more than one document. Each level's windows are half as long as the next
one's, rounded up, and of those inside a window of the next level only the one with the least hash stands
for it; equal windows choose the same. Only windows around repeated ones of the level before are candidates, and
doubling ends when no document has any, or at the final length: a longer window covers no word that its
parts do not. No level but a half is shorter than ``FIRST`` words, since nearly all such windows repeat by chance:
for 13 words the levels are 7 and 13, for 50 they are 7, 13, 25 and 50.

Every task first settles what it can tell from its own documents and sends one entry per window.
So a window that a third of all documents share costs each task one entry.

Windows are compared by two 64-bit hashes made from different hashes of their words.

Empty cases: null and empty texts, and texts with fewer words than a window, lose nothing; an empty table gives an empty
result. Very long texts are cut whole. Other columns are not read. A document
with a null ``doc_id`` has no place in the order: it loses nothing and takes nothing away. Rows that
repeat a ``doc_id`` are not smaller than each other; each is cut by its own text. Different texts of one
``doc_id`` are told apart by a mark, the 64-bit digest of the text, which is zero for all other rows.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import map_batches, schema_of, space_words
from tallyhouse.session import materialise

WINDOW = 13
# Entries a task sorts at once.
CHUNK = 1_000_000
# Entries of a bucket, and how many bytes of text a word has at least on average.
FIRST = 7
BUCKET_ENTRIES, BYTES_PER_WORD = 500_000, 4
MAX_CACHED_WORDS = 200_000
_BASES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_MIX = np.uint64(0x165667B19E3779F9)
# No window stands; a window with this hash is never looked at, which is as likely as two equal hashes.
NONE = np.uint64((1 << 64) - 1)

SENT = "bucket long, numbers binary"


class Hasher:
    """Hashes of words and windows, and the half window that stands for each final window."""

    def __init__(self, window: int):
        from xxhash import xxh3_128_digest

        self.digest, self.known = xxh3_128_digest, {}
        self.window, self.half = window, -(-window // 2)

    def words(self, text: str | None) -> np.ndarray:
        """Two independent 64-bit hashes per word, as two rows."""
        known, out = self.known, []
        for w in space_words(text):
            h = known.get(w)
            if h is None:
                if len(known) > MAX_CACHED_WORDS:
                    known.clear()
                h = known[w] = self.digest(w, 11)
            out.append(h)
        return np.ascontiguousarray(np.frombuffer(b"".join(out), dtype="<u8").reshape(-1, 2).T)

    @staticmethod
    def windows(hashes: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
        n = max(len(hashes) - size + 1, 0)
        value = np.zeros(n, dtype=np.uint64)
        for j in range(size):
            value = value * base + hashes[j : j + n]
        value = (value ^ (value >> np.uint64(31))) * _MIX
        return value ^ (value >> np.uint64(29))

    def standing(self, hashes: np.ndarray, size: int, within: int, below: int | None = None,
                 known: np.ndarray | None = None) -> np.ndarray:
        """Hash of the ``size``-word window that stands for every window of ``within`` words, by start.

        With ``below`` only those stand whose own standing window of that size is among ``known``; ``NONE`` where none does.
        """
        low = self.windows(hashes[0], size, _BASES[0])
        if below is not None:
            low = np.where(np.isin(self.standing(hashes, below, size), known), low, NONE)
        reach, width = within - size + 1, 1
        while 2 * width <= reach:
            low, width = np.minimum(low[:-width], low[width:]), 2 * width
        return np.minimum(low[: len(low) - (reach - width)], low[reach - width :]) if width < reach else low

    def halves(self, hashes: np.ndarray) -> np.ndarray:
        return self.standing(hashes, self.half, self.window)

    def finals(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.windows(hashes[0], self.window, _BASES[0]), self.windows(hashes[1], self.window, _BASES[1])


def _buckets(docs: DataFrame) -> int:
    """As many as keep the entries of a bucket, one per word at most, at about ``BUCKET_ENTRIES``.

    Counted from the bytes of the texts, so a bucket fits a task whatever the session's settings are.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    return max(8, -(-total // (BYTES_PER_WORD * BUCKET_ENTRIES)))


def _send(hashes: np.ndarray, table: np.ndarray, buckets: int):
    """Rows of a 2-d number table as one blob per bucket of their hashes."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    table, bucket = table[order], bucket[order]
    cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            # By column, so that like numbers stand together and compress.
            yield int(bucket[a]), np.ascontiguousarray(table[a:b].T).tobytes()


def _receive(sent: DataFrame, columns: int, solve, out: str) -> DataFrame:
    """Gather each bucket and hand its table to ``solve``."""

    def run(batches):
        bucket, held = None, []
        for b in batches:
            for k, blob in zip(b["bucket"], b["numbers"]):
                if k != bucket:
                    if held:
                        yield solve(np.concatenate(held))
                    bucket, held = k, []
                held.append(np.frombuffer(blob, dtype=np.uint64).reshape(columns, -1).T)
        if held:
            yield solve(np.concatenate(held))

    ordered = sent.repartition("bucket").sortWithinPartitions("bucket")
    return map_batches(ordered, run, schema_of(out))


def _groups(table: np.ndarray, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows by their columns in order; row table and group number by the first ``keys`` columns."""
    table = table[np.lexsort(table.T[::-1])]
    change = np.zeros(len(table), dtype=np.int64)
    if len(table) > 1:
        change[1:] = (table[1:, :keys] != table[:-1, :keys]).any(axis=1)
    return table, np.cumsum(change)


_SIGN = np.uint64(1 << 63)


def _ordered(ids: np.ndarray) -> np.ndarray:
    """Signed ids as unsigned numbers in the same order."""
    return ids.astype(np.int64).view(np.uint64) ^ _SIGN


def _ids(ordered: np.ndarray) -> np.ndarray:
    return (ordered ^ _SIGN).view(np.int64)


def marked(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, mark)`` per row: the mark tells different texts of one ``doc_id`` apart."""
    digest = F.xxhash64("text")
    several = docs.groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high")).where("low <> high")
    several = materialise(several.select("doc_id", F.lit(True).alias("several")), "several")
    mark = F.when(F.col("several"), digest).otherwise(F.lit(0).cast("long"))
    return docs.join(several, "doc_id", "left").select("doc_id", "text", mark.alias("mark"))


def levels(window: int) -> list[int]:
    """Window lengths of the levels, each half of the next."""
    out = [-(-window // 2), window]
    while out[0] > FIRST:
        out.insert(0, -(-out[0] // 2))
    return out


def repeated_windows(docs: DataFrame, size: int, within: int, buckets: int, below: int | None = None) -> DataFrame:
    """``(doc_id, mark, hash)``: standing windows of ``size`` words that also stand in another document.

    After the first level ``docs`` has ``hashes``, the repeated windows of ``below`` words.

    Of texts with one ``doc_id`` in one task, those that share a window pass too; the next level
    compares the documents.
    """

    def settle(pairs: list[np.ndarray]):
        table, group = _groups(np.unique(np.concatenate(pairs), axis=0) if len(pairs) > 1 else pairs[0], 1)
        first = np.r_[True, np.diff(group) > 0]
        size = np.bincount(group)[group]
        # The last column says that the task has settled this window for its own documents.
        send = np.c_[table[first], (size[first] > 1).astype(np.uint64)]
        for bucket, blob in _send(send[:, 0], send, buckets):
            yield bucket, blob
        own = table[size > 1]
        if len(own):
            # Settled entries only pass through, so they go by document: by their window, all documents
            # that share it would meet in one bucket.
            yield from _send(_spread(own[:, 1] ^ own[:, 2]), np.c_[own, np.full(len(own), 2, dtype=np.uint64)], buckets)

    def run(batches):
        hasher, held, entries = Hasher(within), [], 0
        for b in batches:
            for doc_id, mark, text, known in zip(b["doc_id"], b["mark"], b["text"], b.get("hashes", repeat(None))):
                known = None if below is None else np.array(known, dtype=np.int64).view(np.uint64)
                found = np.unique(hasher.standing(hasher.words(text), size, within, below, known))
                found = found[found != NONE]
                if not len(found):
                    continue
                row = np.r_[_ordered(np.array([doc_id])), np.array([mark], dtype=np.int64).view(np.uint64)]
                held.append(np.c_[found, np.broadcast_to(row, (len(found), 2))])
                entries += len(found)
                if entries > CHUNK:
                    yield dict(zip(("bucket", "numbers"), zip(*settle(held))))
                    held, entries = [], 0
        if held:
            yield dict(zip(("bucket", "numbers"), zip(*settle(held))))

    def solve(table: np.ndarray):
        table, group = _groups(table, 1)
        passing = table[:, 3] == 2
        votes = ~passing
        low = np.full(group[-1] + 1, np.iinfo(np.uint64).max, dtype=np.uint64)
        high = np.zeros(group[-1] + 1, dtype=np.uint64)
        np.minimum.at(low, group[votes], table[votes, 1])
        np.maximum.at(high, group[votes], table[votes, 1])
        settled = np.zeros(group[-1] + 1, dtype=bool)
        settled[group[table[:, 3] == 1]] = True
        keep = passing | ((table[:, 3] == 0) & ((low < high) | settled)[group])
        return {
            "doc_id": _ids(table[keep, 1]), "mark": table[keep, 2].view(np.int64), "hash": table[keep, 0].view(np.int64),
        }

    sent = map_batches(docs, run, schema_of(SENT))
    return _receive(sent, 4, solve, "doc_id long, mark long, hash long")


def later_windows(candidates: DataFrame, window: int, buckets: int) -> DataFrame:
    """``(doc_id, mark, start, count)``: runs of final windows that also start in a smaller document.

    ``candidates`` has ``doc_id``, ``mark``, ``text`` and ``hashes``, the repeated half windows of the text.
    """

    def decide(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns k1, k2, doc, mark, start and more: rows of later documents, and rows of the first."""
        table, group = _groups(table, 2)
        first = table[np.r_[True, np.diff(group) > 0], 2][group]
        later = table[:, 2] > first
        return table[later], table[~later]

    def runs(later: np.ndarray) -> dict:
        later = later[np.lexsort((later[:, 4], later[:, 3], later[:, 2]))]
        doc, mark, start = later[:, 2], later[:, 3], later[:, 4].astype(np.int64)
        change = (np.diff(doc) != 0) | (np.diff(mark) != 0) | (np.diff(start) != 1)
        new = np.flatnonzero(np.r_[True, change]) if len(doc) else start
        return {
            "doc_id": _ids(doc[new]), "mark": mark[new].view(np.int64), "start": start[new],
            "count": np.diff(np.r_[new, len(doc)]),
        }

    def settle(held: list[np.ndarray]):
        later, first = decide(np.concatenate(held))
        # Equal windows have equal halves, so the half, sent along by nobody, picks the bucket;
        # windows of one run often share it and come back as one run.
        yield from _send(first[:, 5], first[:, :5], buckets)
        if len(later):
            # Marked by a start beyond any text, so that the receiver lets them pass.
            found = runs(later)
            doc, mark = _ordered(found["doc_id"]), found["mark"].view(np.uint64)
            table = np.c_[
                found["count"].astype(np.uint64), np.zeros(len(doc), dtype=np.uint64), doc, mark,
                found["start"].astype(np.uint64) | _SIGN,
            ]
            yield from _send(_spread(doc ^ mark), table, buckets)

    def run(batches):
        hasher, held, size = Hasher(window), [], 0
        for b in batches:
            for doc_id, mark, text, known in zip(b["doc_id"], b["mark"], b["text"], b["hashes"]):
                words = hasher.words(text)
                half = hasher.halves(words)
                at = np.flatnonzero(np.isin(half, np.array(known, dtype=np.int64).view(np.uint64)))
                if not len(at):
                    continue
                k1, k2 = hasher.finals(words)
                doc = _ordered(np.full(len(at), doc_id))
                own = np.full(len(at), mark, dtype=np.int64).view(np.uint64)
                held.append(np.c_[k1[at], k2[at], doc, own, at.astype(np.uint64), half[at]])
                size += len(at)
                if size > CHUNK:
                    yield dict(zip(("bucket", "numbers"), zip(*settle(held))))
                    held, size = [], 0
        if held:
            yield dict(zip(("bucket", "numbers"), zip(*settle(held))))

    def solve(table: np.ndarray):
        passing = table[:, 4] >= _SIGN
        done, open_ = table[passing], table[~passing]
        # Whole numbers even when empty: joined with floats, ids and marks beyond 2 ** 53 would be rounded.
        none = np.zeros(0, dtype=np.int64)
        out = runs(decide(open_)[0]) if len(open_) else dict.fromkeys(("doc_id", "mark", "start", "count"), none)
        return {
            "doc_id": np.concatenate([out["doc_id"], _ids(done[:, 2])]),
            "mark": np.concatenate([out["mark"], done[:, 3].view(np.int64)]),
            "start": np.concatenate([out["start"], (done[:, 4] ^ _SIGN).astype(np.int64)]),
            "count": np.concatenate([out["count"], done[:, 0].astype(np.int64)]),
        }

    sent = map_batches(candidates.select("doc_id", "mark", "text", "hashes"), run, schema_of(SENT))
    return _receive(sent, 5, solve, "doc_id long, mark long, start long, count long")


def _spread(numbers: np.ndarray) -> np.ndarray:
    value = (numbers ^ (numbers >> np.uint64(31))) * _MIX
    return value ^ (value >> np.uint64(29))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, kept_sha256)`` per row; ``kept`` are the words that stay."""
    # No alias where the name fits: it would make the two shuffles below look different to Spark.
    named = docs.select(id_col, text_col).withColumnsRenamed(
        {a: b for a, b in ((id_col, "doc_id"), (text_col, "text")) if a != b}
    )
    ordered, buckets = marked(named.where("doc_id IS NOT NULL")), _buckets(named)
    key = ["doc_id", "mark"]
    lengths, candidates = levels(window), ordered
    for below, size, within in zip([None, *lengths], lengths, lengths[1:]):
        found = repeated_windows(candidates, size, within, buckets, below)
        survivors = found.groupBy(*key).agg(F.collect_set("hash").alias("hashes"))
        if within != window:
            survivors = materialise(survivors, "survivors")
        candidates = ordered.join(survivors, key)
        if within != window and survivors.isEmpty():
            break
    runs = later_windows(candidates, window, buckets)
    found = runs.groupBy(*key).agg(F.collect_set(F.struct("start", "count")).alias("r"))
    # The same rows by the same key as in the join before, so Spark shuffles the texts once for both.
    joined = ordered.join(found, key, "left").select("doc_id", "text", "r.start", "r.count")
    none = F.lit(None).cast("array<bigint>")
    unnamed = named.where("doc_id IS NULL").select("doc_id", "text", none.alias("start"), none.alias("count"))

    def run(batches):
        for b in batches:
            out = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept", "kept_sha256")}
            for doc_id, text, starts, counts in zip(b["doc_id"], b["text"], b["start"], b["count"]):
                words = space_words(text)
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for s, n in zip(starts or (), counts or ()):
                    gone[s] += 1
                    gone[s + n + window - 1] -= 1
                stays = (np.cumsum(gone)[:-1] == 0).tolist()
                kept = b" ".join([w for w, k in zip(words, stays) if k])
                out["doc_id"].append(doc_id)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - sum(stays))
                out["kept"].append(kept.decode())
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            yield out

    columns = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    return map_batches(joined.unionByName(unnamed), run, schema_of(columns))


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` per row of ``docs``."""
    return remove_repeats(docs, window=window).drop("kept")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
hit AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY s) AS first FROM win) WHERE doc_id > first),
gone AS (
  SELECT doc_id, list(DISTINCT i + j) AS g FROM hit, (SELECT unnest(range(0, 13)) AS j) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k FROM (
    SELECT d.doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p, g FROM d LEFT JOIN gone USING (doc_id))
  WHERE g IS NULL OR NOT list_contains(g, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
