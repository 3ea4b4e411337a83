"""Approximate nearest neighbours: inverted lists scanned dimension block by dimension block.

Vectors are brought to unit length and turned by one random rotation, so that the squared distance of
two unit vectors, 2 - 2 cos, is spread evenly over the dimensions whatever the data.

* The lists' centres come from k-means on a bounded sample; every row is put into the list of its
  nearest centre. A list is split by hash into blocks of bounded size, one row each, whose rotated vectors are stored in
  blocks of columns.
* How many lists a query probes is measured, not set: for a bounded sample of queries the true neighbours
  among all rows are found, and the least number of lists is taken that holds ``TARGET`` of them.
* Every query scans its own list first. The worst of its results so far is the bar for the
  other probed lists. A candidate is dropped as soon as its distance over the dimensions read so far is
  too large to be chance: for a random rotation the share of a squared distance that lies in d of D dimensions has
  mean d / D and variance 2 d (D - d) / (D^2 (D + 2)), and the test allows ``SIGMAS`` deviations.
* What is left is scored by the exact cosine of the original vectors, in double precision.

Vectors that are null, empty, zero, or hold null or not finite components, and those with another number of
components than most, take no part. Rows with a null id are candidates, last among ties, and never queries. Repeated
rows are rows of their own: each is a candidate for the others, and repeated queries each get their rows. Equal
scores are ordered by id. Fewer than ``k`` candidates are all returned; empty tables and tables without
queries give no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import map_batches, schema_of
from tallyhouse.llm.vectors import (
    NO_ID, best, bounded_groups, finite, given_id, nearest, of_common_size, placed, sample_of, top, unpack,
)
from tallyhouse.session import materialise

# About how many rows a list has, and the most lists; beyond them lists grow.
LIST_ROWS, MAX_LISTS = 1024, 4096
# Sampled rows per list for k-means, its rounds, and its seed, which also draws the rotation.
SAMPLE_PER_LIST, ROUNDS, SEED = 64, 8, 7
# Sampled queries that tell how many lists to probe, and the share of true neighbours these must hold.
SAMPLE_QUERIES, TARGET = 128, 0.98
# Columns read between two tests, and the deviations a test allows.
COLUMNS, SIGMAS = 8, 3.0
# Rows of a block that are scored in full to get a first bar.
SEED_ROWS = 64
# About how many rows a block and a batch of queries hold.
BLOCK_ROWS, BATCH_ROWS = 2048, 256

ITEM = "row long, id long, query boolean"
BLOCK = "centre long, rows binary, ids binary, vectors binary, columns binaries"
FOUND = "query long, id long, score double"


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random rotation (with reflections), the same at each run."""
    turned, upper = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return turned * np.sign(np.diag(upper))


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small components stay in range.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each vector with the query; every row is summed alike, so that equal rows get equal scores."""
    norm = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum())
    plain = (vectors * query).sum(axis=1) / norm
    if np.isfinite(plain).all() and norm.min(initial=1.0) > 1e-290:
        return plain
    return (unit(vectors) * unit(query[None, :])).sum(axis=1)


def k_means(points: np.ndarray, number: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    if not len(points):
        return np.zeros((1, max(1, points.shape[1])))
    drawn = np.random.default_rng(seed).permutation(len(points))[:number]
    centres = points[drawn].copy()
    for _ in range(rounds):
        at, _ = nearest(points, centres)
        order, counts = np.argsort(at, kind="stable"), np.bincount(at, minlength=len(centres))
        used = np.flatnonzero(counts)
        centres[used] = np.add.reduceat(points[order], (np.cumsum(counts) - counts)[used]) / counts[used, None]
    return centres


def allowances(size: int, columns: int = COLUMNS, sigmas: float = SIGMAS) -> list[tuple[int, int, float]]:
    """``(from, to, share)`` per block of columns: the share of the bar's distance allowed up to its end."""
    out = []
    for start in range(0, size, columns):
        d = min(start + columns, size)
        deviation = np.sqrt(2 * d * (size - d) / (size * size * (size + 2)))
        out.append((start, d, min(1.0, d / size + sigmas * deviation) * (1 + 1e-4)))
    return out


def scan(columns: list[np.ndarray], query: np.ndarray, bar: float, steps: list[tuple[int, int, float]]) -> np.ndarray:
    """Places of the candidates that no test abandons, for a squared distance of at most ``bar``."""
    alive, far = None, None
    for part, (start, end, share) in zip(columns, steps):
        rows = part if alive is None else part[alive]
        step = ((rows - query[start:end]) ** 2).sum(axis=1)
        far = step if far is None else far + step
        keep = far <= bar * share + 1e-5
        if not keep.all():
            alive = np.flatnonzero(keep) if alive is None else alive[keep]
            far = far[keep]
            if not len(alive):
                break
    return np.arange(len(columns[0])) if alive is None else alive


def build_lists(items: DataFrame, turn: np.ndarray) -> DataFrame:
    """One row per block of a list: ids, original vectors, and the rotated ones in blocks of columns."""
    steps = allowances(len(turn))

    def run(batches):
        for b in batches:
            for centre, members in zip(b["centre"], b["members"]):
                rows, ids = (np.array([m[k] for m in members], dtype=np.int64) for k in ("row", "id"))
                vectors = unpack([m["vector"] for m in members])
                turned = (unit(vectors) @ turn).astype(np.float32)
                columns = [np.ascontiguousarray(turned[:, start:end]).tobytes() for start, end, _ in steps]
                yield {
                    "centre": [centre], "rows": [rows.tobytes()], "ids": [ids.tobytes()], "vectors": [vectors.tobytes()],
                    "columns": [columns],
                }

    parts = bounded_groups(items, "centre", BLOCK_ROWS).groupBy("centre", "part")
    members = parts.agg(F.collect_list(F.struct("row", "id", "vector")).alias("members"))
    return materialise(map_batches(members.select("centre", "members"), run, schema_of(BLOCK)), "lists")


def neighbours_of_sample(below: DataFrame, queries: list, centres: np.ndarray, turn: np.ndarray, k: int) -> list[int]:
    """For each true neighbour of the sampled queries, how many lists nearer the query come before its own."""
    vectors = unpack([q.vector for q in queries])
    own = [q.row for q in queries]
    order = np.argsort(((unit(vectors) @ turn)[:, None, :] - centres[None]).__pow__(2).sum(axis=2), axis=1, kind="stable")
    place = np.argsort(order, axis=1)

    def run(batches):
        for b in batches:
            if not b["vector"]:
                continue
            candidates, ids, rows = unpack(b["vector"]), np.array(b["id"]), np.array(b["row"])
            for n, vector in enumerate(vectors):
                scores = cosines(candidates, vector)
                scores[rows == own[n]] = -2
                keep = top(scores, ids, k)
                keep = keep[scores[keep] > -2]
                lists = np.array(b["centre"])[keep]
                yield {"query": [n] * len(keep), "id": ids[keep], "score": scores[keep], "before": place[n][lists]}

    found = map_batches(below.select("row", "id", "centre", "vector"), run, schema_of(f"{FOUND}, before long"))
    return [r.before for r in best(found, ["query"], k).select("before").collect()]


def lists_to_probe(before: list[int], target: float = TARGET) -> int:
    """The least number of lists that holds the share ``target`` of the neighbours."""
    if not before:
        return 1
    ordered = sorted(before)
    return ordered[int(np.ceil(target * len(ordered))) - 1] + 1


def route(queries: DataFrame, centres: np.ndarray, sizes: np.ndarray, turn: np.ndarray, probes: int, least: int) -> DataFrame:
    """``(row, vector, centre, home)`` for every list that a query probes, until they hold ``least`` rows."""

    def run(batches):
        for b in batches:
            for row, vector, home in zip(b["row"], b["vector"], b["centre"]):
                point = (unit(np.frombuffer(vector)[None, :]) @ turn)[0]
                order = np.argsort(((centres - point) ** 2).sum(axis=1), kind="stable")
                order = np.r_[home, order[order != home]]
                enough = int(np.searchsorted(np.cumsum(sizes[order]), least)) + 1
                to = order[: max(probes, enough)]
                to = to[sizes[to] > 0]
                yield {"row": [row] * len(to), "vector": [vector] * len(to), "centre": to, "home": [home] * len(to)}

    return map_batches(queries, run, schema_of("row long, vector binary, centre long, home long"))


def first_bar(query: dict, rows: np.ndarray, vectors: np.ndarray, asked: np.ndarray, k: int) -> float:
    """The cosine that a result must reach: the one brought along, else the ``k``-th best of the block's first rows."""
    if query["bar"] is not None:
        return query["bar"]
    some = np.flatnonzero(rows[: SEED_ROWS] != query["row"])
    return -1.0 if len(some) < k else float(np.sort(cosines(vectors[some], asked))[-k])


def search(visits: DataFrame, lists: DataFrame, turn: np.ndarray, k: int) -> DataFrame:
    """The best candidates of each visit ``(row, vector, centre, bar)`` of a query to a list."""
    steps = allowances(len(turn))

    def run(batches):
        for b in batches:
            for n in range(len(b["centre"])):
                rows, ids = (np.frombuffer(b[name][n], np.int64) for name in ("rows", "ids"))
                vectors = np.frombuffer(b["vectors"][n]).reshape(len(rows), -1)
                columns = [np.frombuffer(c, np.float32).reshape(len(rows), -1) for c in b["columns"][n]]
                out = ([], [], [])
                for query in b["queries"][n]:
                    asked = np.frombuffer(query["vector"])
                    point = (unit(asked[None, :]) @ turn)[0].astype(np.float32)
                    bar = 2 - 2 * first_bar(query, rows, vectors, asked, k)
                    left = scan(columns, point, bar, steps)
                    left = left[rows[left] != query["row"]]
                    if len(left):
                        scores = cosines(vectors[left], asked)
                        keep = top(scores, ids[left], k)
                        out[0].extend([query["row"]] * len(keep))
                        out[1].extend(ids[left][keep].tolist())
                        out[2].extend(scores[keep].tolist())
                yield dict(zip(("query", "id", "score"), out))

    parts = bounded_groups(visits, "centre", BATCH_ROWS).groupBy("centre", "part")
    batches = parts.agg(F.collect_list(F.struct("row", "vector", "bar")).alias("queries"))
    # Written, so that both sides of the join are plain shuffles and Spark can split a list that many ask.
    batches = materialise(batches.select("centre", "queries"), "visits")
    return map_batches(lists.join(batches, "centre"), run, schema_of(FOUND))


def nearest_neighbours(items: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of ``items`` with ``id``, ``query`` (boolean) and ``vector``."""
    usable = items.where(finite(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    usable, size = of_common_size(usable, "vector")
    numbered = usable.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce("query", F.lit(False)).alias("query"),
        F.transform("vector", lambda x: x.cast("double")).alias("vector"),
    )
    packed = materialise(
        map_batches(
            numbered,
            lambda batches: (b | {"vector": [np.array(v).tobytes() for v in b["vector"]]} for b in batches),
            schema_of(f"{ITEM}, vector binary"),
        ),
        "vectors",
    )
    turn = rotation(max(1, size))
    number = max(1, min(MAX_LISTS, -(-packed.count() // LIST_ROWS)))
    drawn = unpack([r.vector for r in sample_of(packed, SAMPLE_PER_LIST * number).select("vector").collect()])
    centres = k_means(unit(drawn) @ turn if len(drawn) else np.zeros((0, max(1, size))), number)

    below = placed(packed, centres, ITEM, "placed", lambda v: unit(v) @ turn)
    sizes = np.zeros(len(centres), dtype=np.int64)
    for r in below.groupBy("centre").count().collect():
        sizes[r.centre] = r["count"]
    queries = below.where("query").select("row", "id", "vector", "centre")
    asked = sample_of(queries, SAMPLE_QUERIES).collect()
    before = neighbours_of_sample(below, asked, centres, turn, k) if asked and number > 1 else []
    lists = build_lists(below, turn)

    visits = route(queries, centres, sizes, turn, lists_to_probe(before), k + 1)
    visits = materialise(visits, "routes")
    at_home = visits.where("centre = home").withColumn("bar", F.lit(None).cast("double"))
    near = materialise(search(at_home, lists, turn, k), "home-neighbours")
    bars = best(near, ["query"], k).groupBy(F.col("query").alias("row")).agg(
        F.when(F.count("*") == k, F.min("score")).alias("bar")
    )
    away = visits.where("centre <> home").join(bars, "row", "left")
    found = best(near.unionByName(search(away, lists, turn, k)), ["query"], k)
    named = found.join(queries.select(F.col("row").alias("query"), F.col("id").alias("query_id")), "query")
    return named.select("query_id", F.col("rank").cast("int").alias("rank"), given_id("id").alias("vec_id"), "score")


def search_embeddings(embeddings: DataFrame) -> DataFrame:
    """The 5 nearest other rows of each row whose id is divisible by 50."""
    return nearest_neighbours(
        embeddings.select(
            F.col("vec_id").alias("id"), (F.col("vec_id") % 50 == 0).alias("query"), F.col("embedding").alias("vector")
        )
    )
