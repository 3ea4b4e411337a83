"""URL filter: a trie over reversed host labels and path segments, broadcast to all tasks.

A rule ``(host, path)`` fits its host and every subdomain when the URL's path starts
with the rule's path. Among the rules that fit, the longest text ``host + path`` wins;
of two equally long ones the one with the longer host, and block before allow.

Empty cases: a null URL, or one without ``://``, has an empty host and path, which no
rule fits. Such URLs and all others without a rule get the default verdict. A null id stays null, repeated rows are
judged each, very long URLs are read whole, an empty table gives an empty result, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import map_batches, schema_of

# A trie of this many rules stays below about 100 MB in each Python worker.
MAX_BROADCAST_RULES = 200_000

# The rules the query judges by.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def rank(self) -> tuple:
        return len(self.text), len(self.host), self.verdict == "block"


class Node:
    """Trie node. Labels lead down the host, then segments down the path from the host's node."""

    __slots__ = ("labels", "segments", "ends", "lengths")

    def __init__(self):
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        # A rule's last segment is a prefix: '' in '/en/' fits whatever follows the slash.
        self.ends: dict[str, Rule] = {}
        # Their distinct lengths, longest first: a segment is looked up once per length, however many rules end here.
        self.lengths: list[int] = []


def build_trie(rules: Iterable[tuple[str, str, str]]) -> Node:
    """Trie of ``(verdict, host, path)`` rules; of rules for one place the best ranked stays."""
    root = Node()
    for rule in map(Rule._make, rules):
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.labels.setdefault(label, Node())
        *whole, last = rule.path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        if last not in node.ends or rule.rank > node.ends[last].rank:
            if len(last) not in node.lengths:
                node.lengths = sorted([*node.lengths, len(last)], reverse=True)
            node.ends[last] = rule
    return root


def find(root: Node, host: str, path: str) -> Rule | None:
    """Best rule for a URL: walk the host from its last label, and the path at every host node."""
    best, node = None, root
    segments = path.split("/")
    for label in reversed(host.split(".")) if host else ():
        node = node.labels.get(label)
        if node is None:
            break
        place = node
        for segment in segments:
            for length in place.lengths:
                rule = place.ends.get(segment[:length]) if length <= len(segment) else None
                if rule is not None:
                    # Shorter ends of this place rank lower.
                    best = rule if best is None or rule.rank > best.rank else best
                    break
            place = place.segments.get(segment)
            if place is None:
                break
    return best


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow",
    id_col: str = "page_id", url_col: str = "url", max_broadcast: int = MAX_BROADCAST_RULES,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``, repeated rows included.

    More than ``max_broadcast`` rules are not broadcast but joined (:func:`filter_by_join`).
    """
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    if len(rules) > max_broadcast:
        return filter_by_join(urls, rules, default)
    shared = pages.sparkSession.sparkContext.broadcast([tuple(r) for r in rules])

    def judge(batches):
        trie = build_trie(shared.value)
        for b in batches:
            found = [find(trie, h, p) for h, p in zip(b["host"], b["path"])]
            b["rule"] = [r and r.text for r in found]
            b["verdict"] = [r.verdict if r else default for r in found]
            yield b

    return map_batches(urls, judge, schema_of("page_id long, host string, path string, rule string, verdict string"))


def filter_by_join(urls: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """The same verdicts for rule lists of any size: an equal join on host suffixes.

    One candidate per label of the host is joined, so rows grow with the labels and not with
    the rules; the best rule of each distinct (host, path) is a partial aggregate.
    """
    table = urls.sparkSession.createDataFrame(
        [(*r, *Rule._make(r).rank) for r in rules],
        "verdict string, suffix string, prefix string, len int, host_len int, block boolean",
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    places = urls.select("host", "path").distinct()
    best = (
        places.withColumn("suffix", F.explode(suffixes))
        .join(table, "suffix")
        .where(F.col("path").startswith(F.col("prefix")))
        .groupBy("host", "path")
        .agg(F.max(F.struct("len", "host_len", "block", "suffix", "prefix", "verdict")).alias("best"))
    )
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path",
        F.concat("best.suffix", "best.prefix").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
    THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM (SELECT *, CASE
  WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
  WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
  WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
  WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM parts)
"""
