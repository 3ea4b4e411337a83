"""Exact removal of repeated byte strings by a distributed sort of suffixes.

A byte is removed when a string of ``length`` bytes over it also starts anywhere else. Not every
suffix is sorted: of the ``half``-byte substrings inside a string of ``length`` bytes, the one
with the least hash stands for it, the leftmost of equal ones. Equal strings choose the same place, so
only the suffixes at such anchors are sorted, and only those whose substring repeats.

* Every task sorts the anchors' suffixes of its texts into runs and sends them front-coded.
* Runs of one bucket of substrings are merged by a loser tree that knows common prefixes.
* In sorted order anchors with one substring are neighbours. The merge gives their common
  prefixes, sorting the bytes before the anchors gives the other side, and both together
  tell which strings around the anchors are equal. All comparisons are of bytes.
* A second, ``shorter`` length can be told in the same pass: anchors are chosen for it, their suffixes
  reach far enough for ``length``, and every group is looked at for both. What repeats at it only is counted, not removed.

Copies of a whole text are one text throughout. Suffixes with the same surroundings are merged
before they are sent. A substring with more than ``hot`` distinct places is not gathered in
one task: its strings are counted by their SHA-256 digests, by which whole texts are told apart too, with
partial aggregates. Nothing is known to have equal SHA-256 digests but equal strings.

Empty cases: null and empty texts have no bytes and lose none; texts shorter than ``length``
lose none; an empty table gives an empty result; very long texts are hashed in overlapping segments. Columns other than
the id and the text are carried along in a struct or not read. Repeated rows are copies of each other, so both lose all that is ``length`` bytes
or more. A null ``doc_id`` stays null.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import map_batches, schema_of
from tallyhouse.llm.suffix_merge import common_prefix, decode, front_code, merge_runs
from tallyhouse.session import materialise

LENGTH = 400
# Passages of more than 50 words have some 270 bytes or more, so one holds strings of this length.
PASSAGE = 256
# Bytes hashed at once in a task; longer texts are cut with an overlap.
SEGMENT = 1 << 18
# Suffixes of one sorted run, and about how many a bucket gathers.
RUN_ROWS, BUCKET_ROWS = 100_000, 20_000
# Spans of a settled string's row.
TOLD_ROWS = 5_000
# Groups up to this size are compared pair by pair, larger ones by classes.
SMALL_GROUP = 12
HOT = 100_000

SPANS = "tid long, start long, end long, size long"

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
_EMPTY = hashlib.sha256(b"").hexdigest()


class Anchors:
    """Anchors of texts; keeps the powers of the rolling hash."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.half = length // 2
        self.reach = length - self.half + 1
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            step = np.full(n, _BASE, dtype=np.uint64)
            back = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            step[0] = back[0] = 1
            self.powers, self.inverse = np.cumprod(step), np.cumprod(back)

    def of(self, data: bytes, spans: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
        """Anchors of the spans of a buffer: ``(position, hash, first start, last start)``.

        An anchor stands for the strings that start from its first to its last start.
        """
        none = np.zeros(0, dtype=np.int64)
        starts = [np.arange(a, b - self.length + 1) for a, b in spans if b - a >= self.length]
        if not starts:
            return none, none, none, none
        starts = np.concatenate(starts)
        self._grow(len(data))
        raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(raw * self.powers[: len(data)], out=sums[1:])
        value = (sums[self.half :] - sums[: -self.half]) * self.inverse[: len(data) - self.half + 1]
        value = (value ^ (value >> np.uint64(31))) * _MIX
        value ^= value >> np.uint64(29)
        low, at, width = value, np.arange(len(value), dtype=np.int32), 1
        while 2 * width <= self.reach:
            low, at = _least(low, at, low, at, width)
            width *= 2
        if width < self.reach:
            low, at = _least(low, at, low, at, self.reach - width)
        chosen = at[starts].astype(np.int64)
        cut = np.flatnonzero((np.diff(chosen) != 0) | (np.diff(starts) != 1))
        first, last = np.r_[0, cut + 1], np.r_[cut, len(starts) - 1]
        return chosen[first], value[chosen[first]].view(np.int64), starts[first], starts[last]


def _least(low, at, low2, at2, shift):
    """Leftmost minimum of windows and the windows ``shift`` on."""
    a, b = low[: len(low) - shift], low2[shift:]
    keep = a <= b
    return np.where(keep, a, b), np.where(keep, at[: len(a)], at2[shift:])


def text_anchors(texts: list[bytes], finder: Anchors):
    """Per text the lists ``(positions, hashes, first starts, last starts)``."""
    out = [([], [], [], []) for _ in texts]
    buffer, spans, owners = [], [], []
    size = 0

    def flush():
        nonlocal buffer, spans, owners, size
        found = finder.of(b"".join(buffer), spans)
        begins = np.array([a for a, _ in spans])
        which = np.searchsorted(begins, found[2], side="right") - 1
        cuts = np.searchsorted(which, np.arange(len(spans) + 1))
        for i, (text, moved) in enumerate(owners):
            part = slice(cuts[i], cuts[i + 1])
            shift = moved - spans[i][0]
            out[text][1].extend(found[1][part].tolist())
            for k in (0, 2, 3):
                out[text][k].extend((found[k][part] + shift).tolist())
        buffer, spans, owners, size = [], [], [], 0

    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - finder.length + 1, 0), SEGMENT):
            piece = text[at : at + SEGMENT + finder.length - 1]
            buffer.append(piece)
            spans.append((size, size + len(piece)))
            owners.append((i, at))
            size += len(piece)
            if size >= SEGMENT:
                flush()
    if spans:
        flush()
    return out


def sketch(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``(doc_id, digest, n_bytes, anchors...)`` per row."""

    def run(batches):
        finder = Anchors(length)
        for b in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in b["text"]]
            found = text_anchors(texts, finder)
            yield {
                "doc_id": b["doc_id"],
                "digest": [hashlib.sha256(t).hexdigest() for t in texts],
                "n_bytes": [len(t) for t in texts],
                **{name: [f[k] for f in found] for k, name in enumerate(("at", "hash", "first", "last"))},
            }

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    columns = "doc_id long, digest string, n_bytes long, at longs, hash longs, first longs, last longs"
    return map_batches(source, run, schema_of(columns))


def send_runs(found: DataFrame, buckets: int, sizes: list[int]) -> DataFrame:
    """Sorted front-coded runs ``(bucket, meta, shared, rests, before)`` and settled strings (buckets below 0).

    ``found`` has ``(tid, text, places)``, each place ``(at, hash, first, last)``. Suffixes with equal
    surroundings need no partner elsewhere: all their strings repeat, and one of them goes on.
    """
    longest = max(sizes)

    def flush(run: dict):
        settled, kept = [], []
        for (_, text, before, _, _), owners in run.items():
            kept.append((owners[0], text, before))
            if len(owners) > 1:
                settled += owners
        by_bucket = defaultdict(list)
        for (tid, at, h, first, last, _), text, before in kept:
            by_bucket[h % buckets].append((text, before, (tid, at, at - last, at - first)))
        out = {k: [] for k in ("bucket", "meta", "shared", "rests", "before")}
        for bucket, rows in by_bucket.items():
            rows.sort(key=lambda r: r[0])
            shared, rests = front_code(r[0] for r in rows)
            _put(out, bucket, [r[2] for r in rows], shared, rests, [r[1] for r in rows])
        if settled:
            ends = ((t, f, min(la + size, n), size) for t, _, _, f, la, n in settled for size in sizes)
            told = [x for x in ends if x[2] - x[1] >= x[3]]
            # Spread in small pieces, as one bucket would be one task.
            for i in range(0, len(told), TOLD_ROWS):
                _put(out, -1 - (told[i][0] + i) % buckets, told[i : i + TOLD_ROWS], [], [], [])
        return out

    def run(batches):
        held: dict = {}
        for b in batches:
            for tid, text, ats, hashes, firsts, lasts in zip(*(b[k] for k in ("tid", "text", "at", "hash", "first", "last"))):
                data = text.encode("utf-8", "replace")
                for at, h, first, last in zip(ats, hashes, firsts, lasts):
                    key = h, data[at : last + longest], data[first:at], first - at, last - at
                    held.setdefault(key, []).append((tid, at, h, first, last, len(data)))
                if len(held) >= RUN_ROWS:
                    yield flush(held)
                    held = {}
        if held:
            yield flush(held)

    return map_batches(found, run, schema_of("bucket long, meta binary, shared binary, rests binary, before binary"))


def _put(out: dict, bucket: int, meta: list[tuple], shared: list[int], rests: list[bytes], before: list[bytes]) -> None:
    out["bucket"].append(bucket)
    out["meta"].append(np.array(meta, dtype=np.int64).reshape(-1, 4).tobytes())
    out["shared"].append(np.array([shared, [len(r) for r in rests], [len(x) for x in before]], dtype=np.int32).tobytes())
    out["rests"].append(b"".join(rests))
    out["before"].append(b"".join(before))


def _pieces(blob: bytes, sizes: list[int]) -> list[bytes]:
    at, out = 0, []
    for n in sizes:
        out.append(blob[at : at + n])
        at += n
    return out


def open_run(meta: bytes, shared: bytes, rests: bytes, before: bytes):
    """A front-coded run as ``(common prefix, suffix, (tid, at, low, high, bytes before))``."""
    numbers = np.frombuffer(shared, dtype=np.int32).reshape(3, -1).tolist()
    rows = np.frombuffer(meta, dtype=np.int64).reshape(-1, 4).tolist()
    payload = ((*m, x) for m, x in zip(rows, _pieces(before, numbers[2])))
    return decode(numbers[0], _pieces(rests, numbers[1]), payload)


def repeated(group: list[tuple], shared: list[int], length: int):
    """Repeated strings among anchors with one substring, in sorted order of their suffixes.

    A member is ``(tid, at, low, high, before)``; it stands for the strings that start ``low`` to
    ``high`` bytes before ``at``. ``shared[i]`` is the common prefix of suffix ``i`` with the one
    before. Yields ``(tid, start, end)`` of bytes to remove.
    """
    if len(group) <= SMALL_GROUP:
        backs = [m[4][::-1] for m in group]
        for i, j in combinations(range(len(group)), 2):
            a, b = group[i], group[j]
            low = max(a[2], b[2], length - min(shared[i + 1 : j + 1]))
            high = min(a[3], b[3])
            if low > high:
                continue
            high = min(high, common_prefix(backs[i], backs[j]))
            if low <= high:
                for m in (a, b):
                    yield m[0], m[1] - high, m[1] - low + length
        return
    backs = sorted((m[4][::-1], i) for i, m in enumerate(group))
    back_shared = np.array(front_code(b for b, _ in backs)[0])
    back_rank = np.empty(len(group), dtype=np.int64)
    back_rank[[i for _, i in backs]] = np.arange(len(group))
    ahead = np.array(shared)
    ahead[0] = back_shared[0] = 0
    low, high = np.array([m[2] for m in group]), np.array([m[3] for m in group])
    # Classes change only at these distances from the anchor.
    steps = np.unique(np.concatenate([low, high + 1, length - ahead, back_shared + 1]))
    steps = steps[(steps >= low.min()) & (steps <= high.max())]
    for d, until in zip(steps.tolist(), [*(steps[1:] - 1).tolist(), int(high.max())]):
        active = np.flatnonzero((low <= d) & (d <= high))
        front = np.cumsum(ahead < length - d)[active]
        back = np.cumsum(back_shared < d)[back_rank[active]]
        _, inverse, counts = np.unique(front * (len(group) + 1) + back, return_inverse=True, return_counts=True)
        for i in active[counts[inverse] > 1].tolist():
            yield group[i][0], group[i][1] - until, group[i][1] - d + length


def merge_buckets(runs: DataFrame, sizes: list[int]) -> DataFrame:
    """``(tid, start, end, size)`` of bytes repeated by strings of each size, from the runs of all buckets.

    Buckets below 0 hold spans that the run builders could already tell.
    """
    half = min(sizes) // 2

    def spans(group: list[tuple], shared: list[int]):
        if len(group) > 1:
            for size in sizes:
                for span in repeated(group, shared, size):
                    yield *span, size

    def solve(rows: list[tuple]):
        group, shared = [], []
        for n, _, member in merge_runs([open_run(*r) for r in rows]):
            if n < half and group:
                yield from spans(group, shared)
                group, shared = [], []
            group.append(member)
            shared.append(n)
        yield from spans(group, shared)

    def run(batches):
        bucket, rows, out = None, [], []
        for b in batches:
            for k, *row in zip(*(b[c] for c in ("bucket", "meta", "shared", "rests", "before"))):
                if k < 0:
                    told = np.frombuffer(row[0], dtype=np.int64).reshape(-1, 4)
                    yield dict(zip(("tid", "start", "end", "size"), told.T))
                    continue
                if k != bucket:
                    out += solve(rows) if rows else ()
                    bucket, rows = k, []
                rows.append(row)
                if len(out) > 50_000:
                    yield dict(zip(("tid", "start", "end", "size"), zip(*out)))
                    out = []
        out += solve(rows) if rows else ()
        if out:
            yield dict(zip(("tid", "start", "end", "size"), zip(*out)))

    return map_batches(runs, run, schema_of(SPANS))


def hot_spans(found: DataFrame, sizes: list[int]) -> DataFrame:
    """The same spans for very frequent substrings: count the strings around them by digest."""

    def run(batches):
        for b in batches:
            for tid, text, firsts, lasts in zip(*(b[k] for k in ("tid", "text", "first", "last"))):
                data = text.encode("utf-8", "replace")
                for size in sizes:
                    ends = [min(last, len(data) - size) + 1 for last in lasts]
                    starts = [s for first, end in zip(firsts, ends) for s in range(first, end)]
                    keys = [hashlib.sha256(data[s : s + size]).digest() for s in starts]
                    yield {"tid": [tid] * len(starts), "start": starts, "size": [size] * len(starts), "key": keys}

    windows = materialise(map_batches(found, run, schema_of("tid long, start long, size long, key binary")), "hot-windows")
    # Written, so that both sides of the join are plain shuffles and Spark can split a hot string.
    again = materialise(windows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "hot-keys")
    return windows.join(again, "key").select("tid", "start", (F.col("start") + F.col("size")).alias("end"), "size")


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 hot: int = HOT, shorter: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, digest, n_bytes, copies)`` and edited texts ``(digest, text, n_removed, n_spans, kept_sha256,
    n_passage_bytes)``, the last for strings of ``shorter`` bytes, or else of ``length``.

    Texts without an entry in the second table lose nothing, or everything if they have copies.
    """
    sizes = sorted({length, shorter or length})
    if sizes[-1] > length:
        raise ValueError("shorter must not exceed length")
    rows = materialise(sketch(docs, id_col, text_col, sizes[0]), "sketch")
    once = rows.groupBy("digest").agg(
        F.count("*").alias("copies"), F.first(F.struct("at", "hash", "first", "last")).alias("a")
    )
    texts = materialise(once.select(F.monotonically_increasing_id().alias("tid"), "digest", "copies", "a.*"), "texts")
    anchor = F.explode(F.arrays_zip("at", "hash", "first", "last"))
    places = texts.select("tid", anchor.alias("p")).select("tid", "p.*")
    # A table of its own, so that both sides of the join are plain shuffles and Spark can split a hot hash.
    shared = materialise(places.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    hits = materialise(places.join(shared, "hash"), "hits")
    totals = hits.where(F.col("n") <= hot).count()
    buckets = max(1, -(-totals // BUCKET_ROWS))

    content = F.coalesce(F.col(text_col), F.lit(""))
    wanted = hits.select("tid").distinct().join(texts, "tid").select("tid", "digest")
    unique = docs.select(F.sha2(content, 256).alias("digest"), content.alias("text")).dropDuplicates(["digest"])
    bodies = materialise(unique.join(wanted, "digest").select("tid", "text"), "bodies")

    def with_places(chosen):
        per_text = hits.where(chosen).groupBy("tid").agg(
            F.collect_list(F.struct("at", "hash", "first", "last")).alias("p")
        )
        return bodies.join(per_text, "tid").select("tid", "text", "p.at", "p.hash", "p.first", "p.last")

    runs = send_runs(with_places(F.col("n") <= hot), buckets, sizes)
    ordered = runs.repartition("bucket").sortWithinPartitions("bucket")
    spans = merge_buckets(ordered, sizes).unionByName(hot_spans(with_places(F.col("n") > hot), sizes))

    per_text = spans.groupBy("tid").agg(F.collect_set(F.struct("start", "end", "size")).alias("s"))
    edited = _cut_texts(bodies.join(per_text, "tid").select("tid", "text", "s.start", "s.end", "s.size"), length)
    named = materialise(edited.join(texts.select("tid", "digest"), "tid"), "edited")
    copies = texts.select("digest", "copies")
    return rows.select("doc_id", "digest", "n_bytes").join(copies, "digest"), named


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])


def _whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the parts of characters that they cut."""
    inside = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    out = []
    for a, b in spans:
        while inside(a):
            a += 1
        while inside(b):
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _cut_texts(found: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for b in batches:
            out = defaultdict(list)
            for tid, text, *places in zip(*(b[k] for k in ("tid", "text", "start", "end", "size"))):
                data = text.encode("utf-8", "replace")
                by_size = defaultdict(list)
                for start, end, size in zip(*places):
                    by_size[size].append((start, end))
                spans = _union(by_size[length])
                passages = _union(by_size[min(by_size)])
                out["tid"].append(tid)
                out["text"].append(_without(data, _whole_characters(data, spans)).decode())
                out["n_removed"].append(sum(e - s for s, e in spans))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(hashlib.sha256(_without(data, spans)).hexdigest())
                out["n_passage_bytes"].append(sum(e - s for s, e in passages))
            yield out

    columns = "tid long, text string, n_removed long, n_spans long, kept_sha256 string, n_passage_bytes long"
    return map_batches(found, run, schema_of(columns))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT,
           shorter: int | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row of ``docs``.

    With ``shorter`` also ``n_passage_bytes``, the bytes covered by a string of that many bytes that also starts
    anywhere else; the other columns do not depend on it.
    """
    rows, edited = find_repeats(docs, id_col, text_col, length, hot, shorter)
    joined = rows.join(edited.drop("text", "tid"), "digest", "left")
    copied = lambda size: (F.col("copies") > 1) & (F.col("n_bytes") >= size)
    gone, none = copied(length), F.lit(0).cast("long")
    passages = F.when(copied(shorter), F.col("n_bytes")).otherwise(F.coalesce("n_passage_bytes", none)) if shorter else none
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(gone, F.lit(_EMPTY)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        *([passages.alias("n_passage_bytes")] if shorter else []),
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   hot: int = HOT) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text; characters are kept whole.

    No row goes: a text that is removed entirely becomes empty, and a null text stays null.
    """
    rows, edited = find_repeats(docs, id_col, text_col, length, hot)
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    gone = rows.where((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select("digest").distinct()
    changes = edited.select("digest", "text").join(gone, "digest", "left_anti").unionByName(
        gone.withColumn("text", F.lit(""))
    )
    source = docs.select(F.struct("*").alias("doc"), digest.alias("digest"))
    joined = source.join(changes.withColumnRenamed("text", "new_text"), "digest", "left")
    text = F.coalesce("new_text", F.col("doc")[text_col])
    return joined.select(*[(text if c == text_col else F.col("doc")[c]).alias(c) for c in docs.columns])
