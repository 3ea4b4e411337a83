"""Front-coded sorted runs and their merge by a loser tree that never compares known prefixes again."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first ``known`` bytes are equal and not looked at."""
    end = min(len(a), len(b))
    differ = int.from_bytes(a[known:end], "big") ^ int.from_bytes(b[known:end], "big")
    return end - (differ.bit_length() + 7) // 8


def front_code(strings: Iterable[bytes]) -> tuple[list[int], list[bytes]]:
    """Common prefix with the string before, and the rest, of each of some sorted strings."""
    shared, rests, last = [], [], b""
    for s in strings:
        n = common_prefix(last, s)
        shared.append(n)
        rests.append(s[n:])
        last = s
    return shared, rests


def decode(shared: Iterable[int], rests: Iterable[bytes], payloads: Iterable[Any]) -> Iterator[tuple[int, bytes, Any]]:
    """Strings of a run with the length of the prefix each has in common with the one before."""
    last = b""
    for n, rest, payload in zip(shared, rests, payloads):
        last = last[:n] + rest
        yield n, last, payload


def merge_runs(runs: list[Iterator[tuple[int, bytes, Any]]]) -> Iterator[tuple[int, bytes, Any]]:
    """Merge sorted runs: ``(common prefix with the string put out before, string, payload)``.

    Every head carries its common prefix with the last string put out. The longer one is the
    smaller string; only when both are equal are bytes compared, from that length on. A run's next string
    brings the length from the front coding, so no byte is compared twice against one string.
    """
    size = 1
    while size < len(runs):
        size *= 2
    text: list[bytes | None] = [None] * size
    shared = [0] * size
    payload: list[Any] = [None] * size

    def advance(r: int) -> None:
        head = next(runs[r], None) if r < len(runs) else None
        shared[r], text[r], payload[r] = head or (0, None, None)

    def beats(a: int, b: int) -> bool:
        """Whether head a comes out before head b; the loser then knows its prefix with the winner."""
        x, y = text[a], text[b]
        if y is None or x is None:
            return y is None
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        n = common_prefix(x, y, shared[a])
        first = x[n : n + 1] <= y[n : n + 1]
        shared[b if first else a] = n
        return first

    for r in range(size):
        advance(r)
        shared[r] = 0
    losers = [0] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size
        a, b = build(2 * node), build(2 * node + 1)
        won, lost = (a, b) if beats(a, b) else (b, a)
        losers[node] = lost
        return won

    winner = build(1)
    while text[winner] is not None:
        yield shared[winner], text[winner], payload[winner]
        advance(winner)
        node = (winner + size) // 2
        while node:
            if not beats(winner, losers[node]):
                winner, losers[node] = losers[node], winner
            node //= 2
