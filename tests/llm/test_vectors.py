"""Vector search and hard negatives against all products, on odd rows, on given vectors and on nothing."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyhouse.llm import cover_tree, hard_negatives, vector_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def odd_vectors(size=16, n=900):
    """A hot cluster, copies, ties, nulls, odd components, other lengths, short and long vectors, repeated and null ids."""
    rng = random.Random(3)
    draw = lambda spread=1.0, at=0.0: [at + spread * rng.gauss(0, 1) for _ in range(size)]
    rows = [(i, draw(0.2, 0.5) if i % 3 == 0 else draw(), rng.randrange(4) if i % 3 else 1) for i in range(n)]
    copy = draw()
    rows += [(n + i, copy, i % 2) for i in range(60)]
    rows += [(100, draw(), 2), (100, rows[100][1], rows[100][2]), (50, draw(), None), (None, draw(), 1), (None, copy, 3)]
    rows += [(2000, None, 1), (2050, [], 1), (2100, [0.0] * size, 1), (2150, [math.nan] * size, 1), (2200, [math.inf] * size, 2)]
    rows += [(2250, [None, *copy[1:]], 1), (2300, [1.0, 2.0], 1), (2350, [c * 1e-3 for c in copy], 1), (2400, [c * 40 for c in copy], 0)]
    rows += [(2500, draw(), None), (-100, draw(), 3), (-7, draw(), 9)]
    return rows


@pytest.fixture(scope="module", params=["odd", "sf0.01", "none", "one"])
def vectors(request, spark):
    if request.param == "sf0.01":
        return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {"odd": odd_vectors(), "none": [], "one": [(0, [1.0, 2.0], 1)]}[request.param]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return frame.selectExpr("*", *(f"'x' as {n}" for n in ("row", "id", "score", "centre", "anchor", "query", "part", "vector", "rank")))


def given(df):
    return [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]


def usable(rows, zero):
    fit = [
        (i, v, label) for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(x != 0 for x in v))
    ]
    sizes = Counter(len(v) for _, v, _ in fit)
    most = max(sizes, key=lambda s: (sizes[s], s), default=0)
    return [r for r in fit if len(r[1]) == most]


def by_id(i):
    return (i is None, i or 0)


def true_neighbours(rows, k=5):
    rows = usable(rows, zero=False)
    out = []
    for n, (i, v, _) in enumerate(rows):
        if i is not None and i % 50 == 0:
            norm = math.sqrt(math.fsum(x * x for x in v))
            scored = [
                (-math.fsum(x * y for x, y in zip(v, w)) / norm / math.sqrt(math.fsum(y * y for y in w)), by_id(j), j)
                for m, (j, w, _) in enumerate(rows) if m != n
            ]
            out.append((i, [(-s, j) for s, _, j in sorted((round(s, 12), b, j) for s, b, j in scored)[:k]]))
    return out


def check_search(df, found, least=0.9, k=5):
    truth = true_neighbours(given(df), k)
    wanted, got = defaultdict(list), defaultdict(list)
    for i, near in truth:
        wanted[i].append(near)
    for r in found.collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) <= set(wanted)
    hits = total = 0
    for i, lists in wanted.items():
        assert sorted(r for r, *_ in got[i]) == sorted(n + 1 for near in lists for n in range(len(near)))
        if len(lists) == 1:
            ordered = [(s, j) for _, j, s in sorted(got[i], key=lambda x: x[0])]
            assert ordered == sorted(ordered, key=lambda x: (-x[0], by_id(x[1])))
            exact = {j: s for s, j in lists[0]}
            assert all(abs(exact[j] - s) < 1e-11 for s, j in ordered if j in exact)
            hits += len(set(j for _, j in ordered) & set(exact))
            total += len(exact)
    assert hits >= least * total
    return hits, total


def test_search(vectors):
    check_search(vectors, vector_search.search_embeddings(vectors), least=0.95)


def test_search_with_many_lists(vectors, monkeypatch):
    """Small lists, blocks and batches, so that probing, abandoning and splitting all take part."""
    for name, value in (("LIST_ROWS", 40), ("BLOCK_ROWS", 30), ("BATCH_ROWS", 3), ("COLUMNS", 3)):
        monkeypatch.setattr(vector_search, name, value)
    check_search(vectors, vector_search.search_embeddings(vectors))


def test_scan_keeps_what_is_near():
    rng = np.random.default_rng(1)
    points = vector_search.unit(rng.normal(size=(4000, 64))).astype(np.float32)
    steps = vector_search.allowances(64)
    columns = [np.ascontiguousarray(points[:, a:b]) for a, b, _ in steps]
    lost = kept = read = 0
    for q in vector_search.unit(rng.normal(size=(40, 64))).astype(np.float32):
        far = ((points - q) ** 2).sum(axis=1)
        bar = float(np.sort(far)[19])
        left = vector_search.scan(columns, q, bar, steps)
        lost += len(set(np.argsort(far)[:20]) - set(left.tolist()))
        read += len(left)
        kept += 20
    assert lost <= 0.03 * kept and read <= 3 * kept


def test_lists_to_probe():
    assert vector_search.lists_to_probe([]) == 1
    assert vector_search.lists_to_probe([0] * 98 + [5, 9]) == 1
    assert vector_search.lists_to_probe([0] * 97 + [2, 5, 9]) == 3


def brute_negatives(rows):
    fit = []
    for i, v, label in usable(rows, zero=True):
        if label is not None:
            fit.append((i, [math.floor(256 * float(x)) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = Counter()
    for n, (i, v, label) in enumerate(fit):
        if i is None or i % 100:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), by_id(j), j, other == label) for m, (j, w, other) in enumerate(fit) if m != n
        )
        for s, _, p, same in [x for x in scored if x[3]][:5]:
            window = [(j, -t) for t, _, j, kin in scored if not kin and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out.update((i, p, rank, j, -s, t) for rank, (j, t) in enumerate(window, 1))
    return out


def found_negatives(df):
    return Counter(tuple(r) for r in hard_negatives.mine_embeddings(df).collect())


def test_hard_negatives(vectors):
    assert found_negatives(vectors) == brute_negatives(given(vectors))


def test_hard_negatives_in_many_blocks(vectors, monkeypatch):
    for name, value in (("PIVOT_ROWS", 60), ("BLOCK_ROWS", 40), ("BATCH_ROWS", 2)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert found_negatives(vectors) == brute_negatives(given(vectors))


def test_hard_negatives_beyond_doubles(spark):
    """Products of more than 53 bits are exact."""
    rng = random.Random(8)
    rows = [(i * 10, [float(rng.randrange(-(1 << 22), 1 << 22)) for _ in range(5)], i % 3) for i in range(120)]
    assert found_negatives(spark.createDataFrame(rows, SCHEMA)) == brute_negatives(rows)


@pytest.mark.parametrize("kind", ["spread", "clustered", "copies"])
def test_cover_tree(kind):
    """Nodes cover their points, children divide them, and a descent sees all that it must while it skips much."""
    rng = np.random.default_rng(2)
    points = rng.normal(size=(600, 6))
    if kind == "clustered":
        points = 20 * points[:10].repeat(60, axis=0) + 0.05 * points
    if kind == "copies":
        points = np.ones((600, 6))
    labels = rng.integers(0, 5, 600)
    order, nodes = cover_tree.build(points, labels)
    placed, sorts = points[order], labels[order]
    assert sorted(order) == list(range(600)) and (nodes["first"][0], nodes["last"][0]) == (0, 600)
    for node in nodes:
        own = slice(node["first"], node["last"])
        assert (np.sqrt(((placed[own] - placed[node["centre"]]) ** 2).sum(axis=1)) <= node["radius"] + 1e-9).all()
        assert (sorts[own].min(), sorts[own].max()) == (node["low"], node["high"])
        kids = nodes[node["child"] : node["end"]]
        if len(kids):
            assert kids["first"][0] == node["first"] and kids["last"][-1] == node["last"]
            assert (kids["first"][1:] == kids["last"][:-1]).all() and kids["centre"][0] == node["centre"]
            centres = placed[kids["centre"]]
            for n, c in enumerate(centres):
                assert (((centres[:n] - c) ** 2).sum(axis=1) > (node["radius"] / cover_tree.BASE) ** 2).all()
    query = rng.normal(size=6)
    products = placed @ query
    bar, seen = np.sort(products)[-5], []
    cover_tree.descend(
        placed, nodes, query, 1e-9, lambda low, high, part: high >= bar, lambda high: high, lambda a, b: seen.extend(range(a, b))
    )
    assert set(np.flatnonzero(products >= bar)) <= set(seen)
    assert kind != "clustered" or len(seen) < 200
