"""Hard negatives by exact inner-product search in a distributed cover tree.

Candidates get one more component, so that all have the norm of the longest one; an anchor gets a zero
there. Then a ball around a candidate bounds the inner products of all candidates in it, whatever their norms.

* The tree's top are pivots, chosen farthest-first from a bounded sample of rows. Every row
  goes below its nearest pivot; each pivot's covering radius is measured over all its rows.
* A pivot's rows are split by hash into blocks of bounded size. Each block is one row: its
  vectors and the cover tree over them (``cover_tree``).
* Anchors travel in bounded batches of anchors with one home pivot. A batch goes to a pivot only if
  the pivot's bounds leave room for one of its anchors. In a block, best-first descent skips nodes
  outside what is wanted, and leaves are verified exactly.
* Positives are searched below the home pivot first; its worst kept score is the bar for the
  other pivots. With the positives known, every positive gives one window of scores for negatives.

Inner products of whole numbers are exact: as doubles where none can reach 2^53, else as Python
integers; scores beyond a long are given as the nearest long.

Rows with a null label, a null or empty vector, a component that is null or not finite (also after
scaling), or another number of components than most rows, take no part. A null id is no anchor's and comes last
among ties. Repeated rows are rows of their own: an anchor's copy may be its positive, and copied
anchors each get their rows. Equal scores are ordered by id, and rows equal in both are equal in the result.
An anchor without positives, a positive without negatives and an empty table give no rows. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm import cover_tree
from tallyhouse.llm.common import map_batches, schema_of
from tallyhouse.llm.vectors import NO_ID, best, bounded_groups, finite, given_id, of_common_size, placed, sample_of, top, unpack
from tallyhouse.session import materialise

# Rows the pivots are chosen from, the most pivots, and about how many rows one stands for.
SAMPLE_ROWS, MAX_PIVOTS, PIVOT_ROWS = 20_000, 256, 4096
# About how many rows a block and a batch of anchors hold.
BLOCK_ROWS, BATCH_ROWS = 1024, 128

ITEM = "row long, id long, label long, anchor boolean"
BLOCK = "centre long, rows binary, ids binary, labels binary, vectors binary, nodes binary"
FOUND = "anchor long, nth long, id long, score long"
_LONG = (1 << 63) - 1


def scaled(vector: Column, scale: int) -> Column:
    """Components ``floor(scale * x)`` as doubles, also where they exceed a long."""
    def one(x):
        y = x.cast("double") * scale
        # From 2^52 on every double is whole.
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, one)


def augmented(vectors: np.ndarray, peak: float) -> np.ndarray:
    """The vectors with the component that brings all to the norm ``peak``."""
    rest = np.maximum(peak * peak - (vectors**2).sum(axis=1), 0)
    return np.c_[vectors, np.sqrt(rest)]


def pivots_of(points: np.ndarray, number: int) -> np.ndarray:
    """Farthest-first choice: every prefix covers the points with a radius that none of its own pairs undercut."""
    if not len(points):
        return points
    chosen, gap = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < number and gap.max() > 0:
        chosen.append(int(np.argmax(gap)))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def build_blocks(items: DataFrame, peak: float) -> DataFrame:
    """One row per block of a pivot's rows, with its cover tree."""

    def run(batches):
        for b in batches:
            for centre, members in zip(b["centre"], b["members"]):
                rows, ids, labels = (np.array([m[k] for m in members], dtype=np.int64) for k in ("row", "id", "label"))
                vectors = unpack([m["vector"] for m in members])
                order, nodes = cover_tree.build(augmented(vectors, peak), labels)
                columns = (rows, ids, labels, vectors)
                yield {"centre": [centre], "nodes": [nodes.tobytes()]} | {
                    n: [np.ascontiguousarray(c[order]).tobytes()] for n, c in zip(("rows", "ids", "labels", "vectors"), columns)
                }

    parts = bounded_groups(items, "centre", BLOCK_ROWS).groupBy("centre", "part")
    members = parts.agg(F.collect_list(F.struct("row", "id", "label", "vector")).alias("members"))
    return materialise(map_batches(members.select("centre", "members"), run, schema_of(BLOCK)), "tree-blocks")


def make_batches(anchors: DataFrame) -> DataFrame:
    """Anchors of one home pivot together: ``(batch, home, anchors)``."""
    parts = bounded_groups(anchors.withColumnRenamed("centre", "home"), "home", BATCH_ROWS).groupBy("home", "part")
    listed = parts.agg(F.collect_list(F.struct("row", "label", "vector", "bar", "positives")).alias("anchors"))
    return listed.select((F.col("home") * (1 << 40) + F.col("part")).alias("batch"), "home", "anchors")


class Positives:
    """The best rows of the anchor's label, but for its own row."""

    def __init__(self, anchor: dict, k: int, window):
        self.label, self.row, self.k = anchor["label"], anchor["row"], k
        self.bar = -np.inf if anchor["bar"] is None else anchor["bar"]
        self.ids, self.scores = np.zeros(0, dtype=np.int64), np.zeros(0)

    def wanted(self, lower, upper, nodes):
        return (upper >= self.bar) & (nodes["low"] <= self.label) & (nodes["high"] >= self.label)

    def best(self, upper: float) -> float:
        return upper

    def add(self, rows, ids, labels, scores) -> None:
        fit = np.flatnonzero((labels == self.label) & (rows != self.row) & (scores >= self.bar))
        if not len(fit):
            return
        ids, scores = np.concatenate([self.ids, ids[fit]]), np.concatenate([self.scores, scores[fit]])
        keep = top(scores, ids, self.k)
        self.ids, self.scores = ids[keep], scores[keep]
        if len(keep) == self.k:
            self.bar = max(self.bar, self.scores[-1])

    def found(self):
        return [(1, self.ids, self.scores)]


class Negatives:
    """For each positive the best rows of other labels whose score lies in the positive's window."""

    def __init__(self, anchor: dict, k: int, window):
        self.label, self.k = anchor["label"], k
        ordered = sorted((p["rank"], p["score"]) for p in anchor["positives"])
        self.nth = [rank for rank, _ in ordered]
        windows = [window(s) for _, s in ordered]
        # Doubles hold them exactly, unless products can exceed 2^53: then they stay Python integers.
        kind = float if all(abs(x) < 1 << 53 for w in windows for x in w) else object
        self.low, self.high = (np.array(x, dtype=kind) for x in zip(*windows))
        # What a result must reach: the window's lower end, then the worst of enough results.
        self.bars = self.low.copy()
        self.kept = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in self.nth]

    def wanted(self, lower, upper, nodes):
        reach = (upper[:, None] >= self.bars.astype(float)) & (lower[:, None] <= self.high.astype(float))
        fits = (reach & (self.bars <= self.high)).any(axis=1)
        return fits & ((nodes["low"] != self.label) | (nodes["high"] != self.label))

    def best(self, upper: float) -> float:
        return min(upper, float(max(self.high)))

    def add(self, rows, ids, labels, scores) -> None:
        fit = np.flatnonzero((scores >= min(self.bars)) & (scores <= max(self.high)) & (labels != self.label))
        if not len(fit):
            return
        fit = fit[top(scores[fit], ids[fit], len(fit))]
        ids, scores = ids[fit], scores[fit]
        # Best first, so each window is one stretch, of which the first rows count.
        falling = -scores
        starts = np.searchsorted(falling, -self.high, side="left")
        ends = np.searchsorted(falling, -self.bars, side="right")
        for j in np.flatnonzero(ends > starts):
            stretch = slice(starts[j], min(ends[j], starts[j] + self.k))
            found = np.concatenate([self.kept[j][0], ids[stretch]])
            values = np.concatenate([self.kept[j][1], scores[stretch]])
            keep = top(values, found, self.k)
            self.kept[j] = found[keep], values[keep]
            if len(keep) == self.k:
                self.bars[j] = max(self.bars[j], values[keep[-1]])

    def found(self):
        return [(nth, *kept) for nth, kept in zip(self.nth, self.kept)]


def search(pairs: DataFrame, batches: DataFrame, blocks: DataFrame, goal: type, k: int, window, peak: float) -> DataFrame:
    """What each anchor finds in the blocks that its batch is sent to; ``pairs`` are ``(batch, centre)``.

    A task carries an anchor's results, and with them its bars, on over the blocks of an Arrow batch.
    """

    def run(found):
        for b in found:
            goals = {}
            for n in range(len(b["centre"])):
                block = {name: np.frombuffer(b[name][n], np.int64) for name in ("rows", "ids", "labels")}
                vectors = np.frombuffer(b["vectors"][n]).reshape(len(block["ids"]), -1)
                nodes = np.frombuffer(b["nodes"][n], cover_tree.NODES)
                for anchor in b["anchors"][n]:
                    if anchor["row"] not in goals:
                        goals[anchor["row"]] = goal(anchor, k, window)
                    _search_block(np.frombuffer(anchor["vector"]), block, vectors, nodes, goals[anchor["row"]], peak)
            rows = [(row, nth, ids, scores) for row, g in goals.items() for nth, ids, scores in g.found()]
            yield {
                "anchor": [row for row, _, ids, _ in rows for _ in ids],
                "nth": [nth for _, nth, ids, _ in rows for _ in ids],
                "id": [i for _, _, ids, _ in rows for i in ids.tolist()],
                "score": [min(max(int(s), -_LONG), _LONG) for *_, scores in rows for s in scores.tolist()],
            }

    told = pairs.join(batches.drop("home"), "batch").join(blocks, "centre").drop("batch")
    return map_batches(told, run, schema_of(FOUND))


def _search_block(query, block, vectors, nodes, goal, peak) -> None:
    exact = peak * peak < 1 << 52

    def verify(first, last):
        part = slice(first, last)
        scores = vectors[part] @ query if exact else _whole_products(vectors[part], query)
        goal.add(block["rows"][part], block["ids"][part], block["labels"][part], scores)

    cover_tree.descend(vectors, nodes, query, 1e-9 * peak * peak + 1e-6, goal.wanted, goal.best, verify)


def _whole_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products where doubles are too short."""
    whole = [int(x) for x in query]
    return np.array([sum(int(x) * y for x, y in zip(v, whole)) for v in vectors.tolist()], dtype=object)


def route(batches: DataFrame, goal: type, k: int, window, peak: float, pivots: np.ndarray, radii: np.ndarray,
          skip_home: bool) -> DataFrame:
    """``(batch, centre)``: the pivots whose rows may hold a result for an anchor of the batch.

    The pivots, the tree's top level, are at most ``MAX_PIVOTS`` vectors.
    """
    top_nodes = np.zeros(len(pivots), dtype=cover_tree.NODES)
    # A pivot knows its radius but not its labels.
    top_nodes["low"], top_nodes["high"] = -_LONG - 1, _LONG

    def run(found):
        for b in found:
            for batch, home, anchors in zip(b["batch"], b["home"], b["anchors"]):
                fits = np.zeros(len(pivots), dtype=bool)
                for anchor in anchors:
                    query = np.frombuffer(anchor["vector"])
                    spread = radii * float(np.sqrt(query @ query)) + 1e-9 * peak * peak + 1e-6
                    middle = pivots[:, :-1] @ query
                    fits |= goal(anchor, k, window).wanted(middle - spread, middle + spread, top_nodes)
                if skip_home:
                    fits[home] = False
                to = np.flatnonzero(fits & (radii >= 0))
                yield {"batch": [batch] * len(to), "centre": to}

    return map_batches(batches, run, schema_of("batch long, centre long"))


def mine(
    items: DataFrame, n_positive: int = 5, n_negative: int = 10, low: int = 30, high: int = 90, whole: int = 100,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``items`` has ``id``, ``label``, ``anchor`` (boolean) and ``vector`` (whole numbers as doubles). A negative
    fits a positive if ``low * positive <= whole * negative <= high * positive``.
    """
    usable = items.where(finite(F.col("vector")) & F.col("label").isNotNull())
    usable, _ = of_common_size(usable, "vector")
    numbered = materialise(
        usable.select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"),
            F.col("label").cast("long").alias("label"),
            F.coalesce("anchor", F.lit(False)).alias("anchor"),
            F.transform("vector", lambda x: x.cast("double")).alias("vector"),
        ),
        "vectors",
    )
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    rows, peak = numbered.agg(F.count("*"), F.coalesce(F.max(norm), F.lit(0.0))).first()
    # Above this the squares of doubles overflow; such vectors have no inner product that fits a long either.
    peak = min(float(peak) * (1 + 1e-12), 1e150)

    sample = sample_of(numbered, SAMPLE_ROWS).select("vector").collect()
    drawn = np.array([r.vector for r in sample]) if sample else np.zeros((0, 0))
    pivots = pivots_of(augmented(drawn, peak), min(MAX_PIVOTS, -(-rows // PIVOT_ROWS))) if sample else np.zeros((1, 1))

    packed = map_batches(
        numbered,
        lambda batches: (b | {"vector": [np.array(v).tobytes() for v in b["vector"]]} for b in batches),
        schema_of(f"{ITEM}, vector binary"),
    )
    below = placed(packed, pivots, ITEM, "placed", lambda v: augmented(v, peak))
    radii = np.full(len(pivots), -1.0)
    for r in below.groupBy("centre").agg(F.max("far").alias("far")).collect():
        radii[r.centre] = r.far
    blocks = build_blocks(below, peak)

    def window(score: int) -> tuple[int, int]:
        return -(-low * score // whole), high * score // whole

    anchors = below.where("anchor").select("row", "id", "label", "vector", "centre")
    none = F.lit(None).cast("array<struct<rank int, score bigint>>")
    first = materialise(make_batches(anchors.withColumns({"bar": F.lit(None).cast("long"), "positives": none})), "batches")
    home = first.select("batch", F.col("home").alias("centre"))
    near = materialise(search(home, first, blocks, Positives, n_positive, window, peak), "home-positives")
    bars = best(near, ["anchor"], n_positive).groupBy(F.col("anchor").alias("row")).agg(
        F.when(F.count("*") == n_positive, F.min("score")).alias("bar")
    )
    second = make_batches(anchors.join(bars, "row", "left").withColumn("positives", none))
    second = materialise(second, "batches")
    away = route(second, Positives, n_positive, window, peak, pivots, radii, skip_home=True)
    far = search(away, second, blocks, Positives, n_positive, window, peak)
    positives = materialise(
        best(near.unionByName(far), ["anchor"], n_positive).select(
            "anchor", F.col("rank").cast("long").alias("nth"), F.col("id").alias("positive"), F.col("score").alias("positive_score")
        ),
        "positives",
    )

    per_anchor = positives.groupBy(F.col("anchor").alias("row")).agg(
        F.collect_list(F.struct(F.col("nth").cast("int").alias("rank"), F.col("positive_score").alias("score"))).alias("positives")
    )
    third = make_batches(anchors.join(per_anchor, "row").withColumn("bar", F.lit(None).cast("long")))
    third = materialise(third, "batches")
    everywhere = route(third, Negatives, n_negative, window, peak, pivots, radii, skip_home=False)
    negatives = best(search(everywhere, third, blocks, Negatives, n_negative, window, peak), ["anchor", "nth"], n_negative)
    named = negatives.join(positives, ["anchor", "nth"]).join(
        anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor"
    )
    return named.select(
        given_id("anchor_id").alias("anchor_id"), given_id("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        given_id("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 100, with the labels of each seventh row changed."""
    moved = (F.col("label").cast("long") + 1) % 10
    return mine(
        embeddings.select(
            F.col("vec_id").alias("id"),
            F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label").cast("long")).alias("label"),
            (F.col("vec_id") % 100 == 0).alias("anchor"),
            scaled(F.col("embedding"), 256).alias("vector"),
        )
    )


SQL = """
with given as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
),
scored as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
         cast(list_dot_product(a.v, b.v) as bigint) as score
  from given a join given b on a.vec_id <> b.vec_id
  where a.vec_id % 100 = 0
),
positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.id) as integer) as rank,
       n.id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n using (anchor_id)
where not n.same and 30 * p.positive_score <= 100 * n.score and 100 * n.score <= 90 * p.positive_score
qualify rank <= 10
"""
