"""Plain versions of the operators on lists, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def quality(text):
    words = SPACE_WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if SPACE_WORD.search(x)]
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def decontaminate(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = LETTER_WORD.findall(lower(text))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(item)
    out = []
    for doc_id, text in docs:
        w = LETTER_WORD.findall(lower(text))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (items_here := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in items_here if x is not None}
        digest = sha(",".join(sorted(found)).encode())
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def fingerprint(text):
    import xxhash

    w = SPACE_WORD.findall(lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    """Smallest reachable id of every node of a list of ids with links between positions."""
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[find(a)] = find(b)
    ids = defaultdict(list)
    for i, n in enumerate(nodes):
        if n is not None:
            ids[find(i)].append(n)
    return [min(ids[find(i)], default=None) for i in range(len(nodes))]


def simhash(docs):
    prints = [fingerprint(t) for _, t in docs]
    n = range(len(docs))
    linked = [
        (i, j) for i in n for j in n[:i]
        if (prints[i] ^ prints[j]).bit_count() <= 3 or (docs[i][0] is not None and docs[i][0] == docs[j][0])
    ]
    named = components([d for d, _ in docs], linked)
    return [(d, f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, named)]


def removed_bytes(docs, length=400):
    """Per text the set of removed byte positions."""
    data = [(t or "").encode() for _, t in docs]
    count = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    return data, [
        {i + j for i in range(len(b) - length + 1) if count[b[i : i + length]] > 1 for j in range(length)} for b in data
    ]


def suffix(docs, length=400):
    out = []
    for (doc_id, _), b, gone in zip(docs, *removed_bytes(docs, length)):
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((doc_id, len(b), len(gone), spans, sha(bytes(x for i, x in enumerate(b) if i not in gone))))
    return out


def word_windows(docs, size=13):
    first = {}
    texts = [(d, SPACE_WORD.findall(t or "")) for d, t in docs]
    for d, w in texts:
        if d is not None:
            for i in range(len(w) - size + 1):
                k = tuple(w[i : i + size])
                first[k] = min(d, first.get(k, d))
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - size + 1):
            if d is not None and first[tuple(w[i : i + size])] < d:
                gone |= set(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), sha(kept.encode())))
    return out


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    w = LETTER_WORD.findall(lower(text))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        here = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += here
        labels |= {label} if here else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def license_method(text, rules):
    """Labels and score of the rules: all matches on the normalised text, and none within a better or equal one."""
    norm = " " + " ".join(LETTER_WORD.findall(lower(text))) + " "
    found = set()
    for r in rules:
        for m in re.finditer(r.regex, norm):
            first = norm.count(" ", 0, m.start()) - 1
            found.add((first, -(first + m[0].count(" ")), r.priority, r.label, r.confidence))
    ordered, kept = sorted(found), []
    for n, (first, last, priority, label, sure) in enumerate(ordered):
        inside = any(-other[1] >= -last and other[2] <= priority for other in ordered[:n])
        if not inside:
            kept.append((label, sure))
    return {label for label, _ in kept}, max((sure for _, sure in kept), default=0.0)


def verdict(url):
    url = url or ""
    rest = url.partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = lower(host)
    best = None
    for verdict, h, p in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = h + p, verdict
    return host, path, best and best[0], best[1] if best else "allow"


def crc_ids(ids):
    import struct

    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def alignment(docs, a_encode, a_bytes, b_encode, b_bytes):
    """Per document ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha)``; all links are listed."""
    linked, heads = [], []
    for doc_id, text in docs:
        whole = (" " + (text or "")).encode()
        a, b = (a_encode(" " + text), b_encode(text)) if text else ([], [])
        if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        groups, x, y = [], [], []
        left = right = b""
        b_rest = list(b)
        for i in a:
            x.append(i)
            left += a_bytes(i)
            while b_rest and len(right) < len(left):
                y.append(b_rest.pop(0))
                right += b_bytes(y[-1])
            if len(left) == len(right):
                groups.append((x, y))
                x, y = [], []
        links = [(i, j) for x, y in groups for i in x for j in y]
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        linked.append(links)
        heads.append((doc_id, len(a), len(b), len(groups), len(links), sha(shown.encode()) if groups else ""))
    counts = Counter(pair for links in linked for pair in set(links))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    return [
        (*h[:5], sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), h[5])
        for h, links in zip(heads, linked)
    ]
