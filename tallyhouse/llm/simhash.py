"""SimHash near-duplicates by generalised pigeonhole.

Each document gets a 64-bit fingerprint; fingerprints link at ``RADIUS`` or fewer differing bits.
To find links, correlated bits are grouped into parts, and every part ``i`` gets a threshold
``t_i >= -1`` with ``sum(t_i + 1) = RADIUS + 1``: two fingerprints within the radius must be within
``t_i`` on some part. A dynamic programme spends these units where they cost least, by estimates of the
candidates from the pair counts of all bits over all fingerprints. A fingerprint is filed under its
value on a part and probes the values within the threshold; all candidates are verified.

Equal fingerprints are one node, so a group of copies of any size is one row. A bucket of many
near copies is cut into cells of bounded size that together compare every pair; a cell returns
a spanning forest of its links, never the pairs.

Empty cases: texts without words, null or empty, have fingerprint zero and link like any other.
Rows with a null ``doc_id`` get a fingerprint and the component of that fingerprint, null if no
other row names it. Repeated rows are in one component and stay repeated rows; rows with one
``doc_id`` and different texts are one document, which links their fingerprints. ``keep_one`` goes by
the texts alone: there such rows are copies only if their fingerprints are linked without their id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyhouse.llm.common import LOWER_TABLE, map_batches, schema_of
from tallyhouse.llm.components import components
from tallyhouse.session import materialise

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
# Relative cost of one row through the shuffles and of comparing one pair.
ROW_COST, PAIR_COST = 5e-6, 2e-9
# Rows of a bucket that are compared in one cell, about.
CELL_ROWS = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").translate(LOWER_TABLE).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(size + 1) - 1
        starts = (ends - size)[: len(words) - shingle + 1].tolist()
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    ones = np.zeros(BITS, dtype=np.int64)
    values = np.array(hashes, dtype="<u8")
    for at in range(0, len(values), 1 << 16):
        block = values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` per row; the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "fp": [_signed(fingerprint(t)) for t in b["text"]]}

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(source, run, schema_of("doc_id long, fp long"))


def _as_unsigned(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.int64).view(np.uint64)


def pair_counts(nodes: DataFrame) -> np.ndarray:
    """How often bits i and j are both set, over all fingerprints; the diagonal has single bits."""

    def run(batches):
        total = np.zeros((BITS, BITS))
        for b in batches:
            bits = np.unpackbits(_as_unsigned(b["fp"]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            x = bits.astype(np.float32)
            total += x.T @ x
        yield {"cell": list(range(BITS * BITS)), "n": total.astype(np.int64).ravel().tolist()}

    sums = map_batches(nodes.select("fp"), run, schema_of("cell long, n long")).groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(BITS * BITS)
    for cell, n in sums.collect():
        counts[cell] = n
    return counts.reshape(BITS, BITS)


def group_bits(counts: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Cut the bits into ``parts`` groups of nearly equal size, correlated bits together."""
    p = np.diag(counts) / max(n, 1)
    cov = counts / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs(cov / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    free, groups = list(range(BITS)), []
    for i in range(parts):
        size = BITS // parts + (i < BITS % parts)
        own = [max(free, key=lambda b: tie[b][free].sum())]
        free.remove(own[0])
        while len(own) < size:
            own.append(max(free, key=lambda b: tie[b][own].sum()))
            free.remove(own[-1])
        groups.append(own)
    return groups


def close_share(counts: np.ndarray, n: int, bits: list[int], most: int) -> list[float]:
    """Estimated share of pairs that differ in at most 0..most of these bits.

    The bits are taken as a chain, each depending on the one before; the state of the recursion is
    the current bit of both fingerprints and the number of differences so far.
    """
    n = max(n, 1)
    p = np.clip(np.diag(counts) / n, 1e-9, 1 - 1e-9)
    first = bits[0]
    q = np.array([1 - p[first], p[first]])
    state = np.zeros((2, 2, most + 1))
    for x in (0, 1):
        for y in (0, 1):
            if (d := int(x != y)) <= most:
                state[x, y, d] = q[x] * q[y]
    for a, b in zip(bits, bits[1:]):
        both = counts[a, b] / n
        given = np.array([[1 - (p[b] - both) / (1 - p[a]), (p[b] - both) / (1 - p[a])], [1 - both / p[a], both / p[a]]])
        given = np.clip(given, 0, 1)
        new = np.zeros_like(state)
        for x in (0, 1):
            for y in (0, 1):
                move = np.einsum("ijd,i,j->d", state, given[:, x], given[:, y])
                if x == y:
                    new[x, y] += move
                else:
                    new[x, y, 1:] += move[:-1]
        state = new
    return np.cumsum(state.sum(axis=(0, 1))).tolist()


def allot(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Cheapest thresholds: ``costs[i][u]`` is part i's cost with ``u`` units, threshold ``u - 1``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for u, own in enumerate(row):
                if spent + u <= units and (spent + u not in new or cost + own < new[spent + u][0]):
                    new[spent + u] = cost + own, [*chosen, u - 1]
        best = new
    return best[units]


def plan(counts: np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Bit groups and thresholds with the least estimated cost, over two to ``radius + 1`` parts."""
    choices = []
    for parts in range(2, radius + 2):
        groups = group_bits(counts, n, parts)
        costs = []
        for bits in groups:
            share = close_share(counts, n, bits, radius)
            rows = [sum(comb(len(bits), j) for j in range(t + 1)) for t in range(radius + 1)]
            costs.append([0.0] + [n * rows[t] * ROW_COST + n * n * share[t] / 2 * PAIR_COST for t in range(radius + 1)])
        cost, thresholds = allot(costs, radius + 1)
        choices.append((cost, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]))
    return min(choices, key=lambda c: c[0])[1]


def signatures(nodes: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """``(part, key, owner, fp, id)``: the value of a fingerprint on a part, and the values it probes."""
    entries = []
    for i, (bits, threshold) in enumerate(parts):
        mask = sum(1 << b for b in bits)
        for t in range(threshold + 1):
            for flipped in combinations(bits, t):
                flip = sum(1 << b for b in flipped)
                entries.append((i, _signed(mask), _signed(flip), t == 0))
    table = F.array(
        *[
            F.struct(F.lit(i).alias("part"), F.lit(m).alias("mask"), F.lit(f).alias("flip"), F.lit(o).alias("owner"))
            for i, m, f, o in entries
        ]
    )
    spread = nodes.withColumn("s", F.explode(table))
    key = F.col("fp").bitwiseAND(F.col("s.mask")).bitwiseXOR(F.col("s.flip"))
    return spread.select("s.part", key.alias("key"), "s.owner", "fp", "id")


def cells(filed: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Signature rows of the buckets that can have links, large buckets cut into cells.

    A bucket of ``c`` chunks has a cell for every two of them; each row goes to the ``c`` cells
    of its chunk, so that every two rows meet in one cell of about two chunks.
    """
    buckets = (
        filed.groupBy("part", "key")
        .agg(F.count("*").alias("n"), F.count_if("owner").alias("owners"))
        .where("n > 1 AND owners > 0")
        .select("part", "key", F.ceil(F.col("n") / cell_rows).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    return (
        filed.join(buckets, ["part", "key"])
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(others))
        .select(
            "part", "key", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"),
            "owner", "fp", "id",
        )
    )


def forest(fp: np.ndarray, owner: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Root of every row: rows of one bucket that links connect have one root.

    All rows are compared with the row ``s`` places on, for rising ``s``, as long as a bucket is
    that long; pairs already connected are left out, so few reach the joining step.
    """
    n = len(fp)
    root = np.arange(n)
    left = np.arange(n)
    for s in range(1, n):
        left = left[left + s < n]
        left = left[bucket[left] == bucket[left + s]]
        if not len(left):
            break
        i = left[(root[left] != root[left + s]) & (owner[left] | owner[left + s])]
        linked = i[np.bitwise_count(fp[i] ^ fp[i + s]) <= radius]
        for x in linked.tolist():
            a, b = x, x + s
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            if a != b:
                root[max(a, b)] = min(a, b)
        if len(linked):
            while not np.array_equal(up := root[root], root):
                root = up
    return root


def links(celled: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)``: a spanning forest of the verified links of every cell."""
    where = ["part", "key", "a", "b"]

    def solve(held: dict[str, np.ndarray], upto: int) -> dict[str, list]:
        part = {k: v[:upto] for k, v in held.items()}
        root = forest(part["fp"], part["owner"], part["bucket"], radius)
        moved = np.flatnonzero(root != np.arange(upto))
        return {"a": part["id"][moved], "b": part["id"][root[moved]]}

    def run(batches: Iterator[dict[str, list]]):
        held: dict[str, np.ndarray] = {}
        for b in batches:
            new = {k: np.array(b[k], dtype=np.int64) for k in (*where, "id")}
            new |= {"fp": _as_unsigned(b["fp"]), "owner": np.array(b["owner"], dtype=bool)}
            held = {k: np.concatenate([held[k], v]) for k, v in new.items()} if held else new
            change = np.zeros(len(held["fp"]), dtype=bool)
            for k in where:
                change[1:] |= held[k][1:] != held[k][:-1]
            last = int(np.flatnonzero(change)[-1]) if change.any() else 0
            if last:
                yield solve(held | {"bucket": np.cumsum(change)}, last)
                held = {k: v[last:] for k, v in held.items()}
        if held:
            yield solve(held | {"bucket": np.zeros(len(held["fp"]), dtype=np.int64)}, len(held["fp"]))

    ordered = celled.repartition(*where).sortWithinPartitions(*where)
    return map_batches(ordered, run, schema_of("a long, b long"))


def _several(prints: DataFrame) -> DataFrame:
    """The ``doc_id`` that repeat with different fingerprints."""
    return (
        prints.where("doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .where("low <> high").select("doc_id")
    )


def _same_document(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the fingerprints of one ``doc_id`` that repeats with different texts."""
    return prints.join(_several(prints), "doc_id").join(nodes, "fp").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))


def _near(nodes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the ids of near fingerprints that connect all of them."""
    n = nodes.count()
    parts = plan(pair_counts(nodes), n)
    return links(cells(materialise(signatures(nodes, parts), "signatures")))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``."""
    prints = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = materialise(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    found = components(_near(nodes).unionByName(_same_document(prints, nodes)))
    labels = nodes.join(found, nodes["id"] == found["node"], "left").select(
        "fp", F.coalesce("component", "id").alias("component_id")
    )
    return prints.join(labels, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_fingerprint(rows: DataFrame) -> DataFrame:
    """``rows`` of ``(doc_id, text, doc)`` with the fingerprint ``fp`` of each text."""

    def run(batches):
        for b in batches:
            own = [_signed(fingerprint(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, type=pa.int64())], names=[*b.schema.names, "fp"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("fp", T.LongType())]))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near texts, the one with the smallest id and fingerprint.

    Rows with a null id cannot be told apart and all stay. Rows travel as one struct, so that no
    name of theirs can clash with those used here.
    """
    prints = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    # A fingerprint is its own node: by doc_id, different texts of one id would be one.
    nodes = prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    nodes = materialise(nodes.withColumn("id", F.col("fp")), "nodes")
    found = components(_near(nodes))
    labels = nodes.join(found, nodes["id"] == found["node"], "left")
    first = labels.groupBy(F.coalesce("component", "id")).agg(F.min(F.struct("doc_id", "fp")).alias("first"))
    first = materialise(first.select("first.doc_id", "first.fp"), "first")
    # Only where an id has different fingerprints do the rows need theirs to be told apart.
    several = materialise(_several(prints), "several")
    exact = materialise(first.join(several, "doc_id", "left_semi"), "exact")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.struct("*").alias("doc"))
    named = rows.join(first.join(several, "doc_id", "left_anti"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    texts = _with_fingerprint(rows.join(exact, "doc_id", "left_semi"))
    told = texts.join(exact, ["doc_id", "fp"], "left_semi").dropDuplicates(["doc_id", "fp"])
    kept = named.select("doc").unionByName(told.select("doc")).unionByName(rows.where("doc_id IS NULL").select("doc"))
    return kept.select("doc.*")
