"""A cover tree over the points of one block, kept as arrays so that it travels in one row.

A node covers a contiguous range of the points and knows its centre (one of them), its covering radius
(the distance of its farthest point, measured, not the level's bound), its children and the least and
greatest label below it. Children's centres lie further apart than the next level's reach, and each
child covers what lies within it; the node's own centre is the centre of its first child. A node that
the next level would scatter into children of few points each is a leaf.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np

# The reach of a level over that of the next one.
BASE = 1.3
# Nodes of up to this many points are leaves, and those whose children would hold fewer than the second number on average.
LEAF, SPLIT = 128, 32

NODES = np.dtype(
    [("centre", "i4"), ("first", "i4"), ("last", "i4"), ("child", "i4"), ("end", "i4"), ("radius", "f8"),
     ("low", "i8"), ("high", "i8")]
)


def build(points: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, nodes)``: the points' order and the nodes, whose ranges and centres refer to it."""
    order = np.arange(len(points))
    middle = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    nodes, at = [_node(order, 0, len(order), middle, points, labels)], 0
    while at < len(nodes):
        node = nodes[at]
        first, last = node["first"], node["last"]
        rows = order[first:last].copy()
        if len(rows) > LEAF and node["radius"] > 0:
            children = _net(points[rows], int(np.flatnonzero(rows == node["centre"])[0]), node["radius"] / BASE)
            if children is not None:
                child_of, centres = children
                node["child"], node["end"] = len(nodes), len(nodes) + len(centres)
                order[first:last] = rows[np.argsort(child_of, kind="stable")]
                ends = first + np.cumsum(np.bincount(child_of, minlength=len(centres)))
                for start, end, centre in zip([first, *ends[:-1]], ends, rows[centres]):
                    nodes.append(_node(order, start, end, centre, points, labels))
        at += 1
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    for node in nodes:
        node["centre"] = place[node["centre"]]
    return order, np.array([tuple(n[f] for f in NODES.names) for n in nodes], dtype=NODES)


def _node(order, first, last, centre, points, labels) -> dict:
    rows = order[first:last]
    radius = float(np.sqrt(((points[rows] - points[centre]) ** 2).sum(axis=1).max()))
    low, high = labels[rows].min(), labels[rows].max()
    return {"centre": centre, "first": first, "last": last, "child": 0, "end": 0, "radius": radius, "low": low, "high": high}


def _net(points: np.ndarray, centre: int, reach: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Child of each point and the children's centres; none if they hold fewer than ``SPLIT`` points on average."""
    child_of, centres = np.full(len(points), -1), []
    open_, next_ = np.arange(len(points)), centre
    while len(open_):
        near = ((points[open_] - points[next_]) ** 2).sum(axis=1) <= reach * reach
        near |= open_ == next_
        child_of[open_[near]] = len(centres)
        centres.append(next_)
        open_ = open_[~near]
        if SPLIT * len(centres) > len(points):
            return None
        next_ = open_[0] if len(open_) else 0
    return child_of, np.array(centres)


def descend(
    vectors: np.ndarray, nodes: np.ndarray, query: np.ndarray, slack: float,
    wanted: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], best: Callable[[float], float],
    verify: Callable[[int, int], None],
) -> None:
    """Best-first descent for the inner product of ``query`` with the points.

    A point of a node differs from its centre by at most the covering radius, so its inner product
    lies between ``lower`` and ``upper``. ``wanted(lower, upper, nodes)`` tells which nodes may hold a
    result, at the time of asking; ``best(upper)`` is what the node could give at most and sets the order;
    ``verify(first, last)`` looks at the points of a leaf.
    """
    length = float(np.sqrt(query @ query))

    def bounds(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle, spread = vectors[part["centre"]] @ query, part["radius"] * length + slack
        return middle - spread, middle + spread

    def push(numbers: np.ndarray) -> None:
        lower, upper = bounds(nodes[numbers])
        for k in np.flatnonzero(wanted(lower, upper, nodes[numbers])):
            heapq.heappush(heap, (-best(upper[k]), int(numbers[k]), lower[k], upper[k]))

    heap: list[tuple] = []
    push(np.zeros(1, dtype=np.int64))
    while heap:
        _, number, lower, upper = heapq.heappop(heap)
        node = nodes[number]
        if not wanted(np.array([lower]), np.array([upper]), nodes[number : number + 1])[0]:
            continue
        if node["child"] == node["end"]:
            verify(int(node["first"]), int(node["last"]))
        else:
            push(np.arange(node["child"], node["end"]))
