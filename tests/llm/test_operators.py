"""Each operator against its plain version, on odd rows, on given documents and on nothing."""

from collections import Counter, defaultdict

import brute
import public_tokenizers
import pytest

from tallyhouse.llm import decontaminate, licenses, packing, quality, simhash, suffix_dedup, token_counts, url_filter, word_windows

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def texts(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["odd", "sample", "nothing"])
def docs(request):
    return request.getfixturevalue(request.param)


def test_quality(docs):
    found = quality.judge(docs).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
    assert rows(found.drop("kept")) == Counter((d, *brute.quality(t)) for d, t in texts(docs))
    verdicts = [(r.doc_id, r.base_failed, r.kept) for r in found.collect()]
    assert not [v for v in verdicts if v[1] and v[2]]
    left = quality.keep_good(docs)
    assert left.columns == docs.columns
    assert Counter(d for d, _ in texts(left)) == Counter(d for d, _, kept in verdicts if kept)


def test_quality_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    judged = quality.judge(docs.join(labels.select("doc_id"), "doc_id")).select("failed_rules").collect()
    assert {name for r in judged for name in r.failed_rules} <= {"too_short", "repeated_windows"}


def test_packing(docs):
    from array import array

    from tokenizers import Tokenizer

    packed = packing.pack(docs, JSON, RANKS).collect()
    reference = Tokenizer.from_file(JSON)
    wanted = Counter()
    for d, t in texts(docs):
        wanted[d, tuple(reference.encode(t or "", add_special_tokens=False).ids) + (1,)] += 1
    pieces = defaultdict(list)
    for p in packed:
        assert p.length > 0 and len(p.ids) == 4 * p.length
        ids = tuple(array("I", bytes(p.ids)))
        assert p.ids_crc32 == brute.crc_ids(ids)
        pieces[p.doc_id, p.doc_tokens].append((p.start, ids))
    # Pieces of documents with one id and one length are told apart by the ids they must give.
    for (d, ids), n in wanted.items():
        own = Counter(pieces[d, len(ids)])
        at = 0
        while at < len(ids):
            part = next(x for x in own if x[0] == at and x[1] == ids[at : at + len(x[1])])
            assert own[part] >= n
            at += len(part[1])
    assert sum(p.length for p in packed) == sum(len(ids) * n for (_, ids), n in wanted.items())
    sequences = defaultdict(list)
    for p in packed:
        sequences[p.sequence_id].append((p.offset, p.length))
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
        padding += 0 if end & (end - 1) == 0 else 2048 - end
    assert padding <= 0.01 * sum(p.length for p in packed)


def test_packing_without_ids_gives_the_same_pieces(sample):
    long, short = packing.pack(sample, JSON, RANKS), packing.pack(sample, JSON, RANKS, keep_ids=False)
    assert rows(long.drop("ids")) == rows(short)


def test_packing_over_many_tasks(sample):
    """Sequences are filled over tasks as well as within them."""
    packed = packing.pack(sample.repartition(40), JSON, RANKS, keep_ids=False)
    fills = Counter()
    for r in packed.collect():
        fills[r.sequence_id] += r.length
    assert max(fills.values()) == 2048
    assert sum(2048 - f for f in fills.values() if f & (f - 1)) <= 0.01 * sum(fills.values())
    assert max(r for r in fills if r >= packing.LAST_BASE) - packing.LAST_BASE < 100


def test_decontamination(docs, spark):
    items = [(i, t) for i, t, *_ in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items += [(900, "日本 the"), (901, ""), (902, None), (None, "of and"), (900, "日本 the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wanted = Counter(brute.decontaminate(texts(docs), items))
    assert rows(decontaminate.report(decontaminate.scan(docs, bench))) == wanted
    assert rows(decontaminate.report(decontaminate.scan(docs, bench, block_words=100))) == wanted
    given = texts(docs)
    left = decontaminate.remove_documents(docs, bench)
    assert left.columns == docs.columns
    verdicts = brute.decontaminate(given, items)
    assert Counter(texts(left)) == Counter(t for t, (*_, dirty) in zip(given, verdicts) if not dirty)


def test_decontamination_judges_rows(spark):
    """Rows without an id, or with the id of another row, go by their own text only."""
    item = "zero one two three four five six seven eight nine ten eleven twelve"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    given = [(None, item), (None, "clean words"), (3, "so " + item), (3, "clean as well"), (4, None)]
    docs = spark.createDataFrame([(*r, "x") for r in given], "doc_id long, text string, row string")
    left = decontaminate.remove_documents(docs, bench)
    assert left.columns == docs.columns and Counter(texts(left)) == Counter([given[1], given[3], given[4]])
    cut = decontaminate.remove_spans(docs, bench)
    assert cut.columns == docs.columns and {r.row for r in cut.collect()} == {"x"}
    assert Counter((d, t and " ".join(t.split())) for d, t in texts(cut)) == Counter(
        [(None, ""), given[1], (3, "so"), given[3], given[4]]
    )


def test_decontamination_cuts_spans(spark, sample):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    hits = {r.doc_id: set(r.hits) for r in decontaminate.scan(sample, bench).collect()}
    assert any(hits.values())
    whole = {d: brute.LETTER_WORD.findall(brute.lower(t)) for d, t in texts(sample)}
    for block_words in (decontaminate.BLOCK_WORDS, 100):
        cut = decontaminate.remove_spans(sample, bench, block_words=block_words)
        assert cut.columns == sample.columns
        left = {d: brute.LETTER_WORD.findall(brute.lower(t)) for d, t in texts(cut)}
        assert left == {d: [w for i, w in enumerate(ws) if i not in hits[d]] for d, ws in whole.items()}
    same = {d: t for d, t in texts(sample) if not hits[d]}
    assert same == {d: t for d, t in texts(cut) if not hits[d]}


def test_token_counts(docs, tmp_path):
    import sentencepiece

    model_path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    wanted = Counter()
    for d, t in texts(docs):
        n = len(model.encode(t or ""))
        wanted[d, len((t or "").encode()), n, n > 4096] += 1
    cache = str(tmp_path / "cache")
    assert rows(token_counts.count_tokens(docs, cache, model_path)) == wanted
    size = docs.sparkSession.read.parquet(cache).count()
    assert size == len({t or "" for _, t in texts(docs)})
    assert rows(token_counts.count_tokens(docs, cache, model_path)) == wanted
    assert docs.sparkSession.read.parquet(cache).count() == size


URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://A.NET/en/x?q=/de/", "http://example.net/en/",
    "http://x.example.net/en", "http://example.com/de/x#y", "http://notexample.com/de/", "http://a.org/fr/", "http://org/fr/1",
    "http://net/", "x://y://z.net/a", "http://b.net?c/en/", "http://.net/", "http://a.example.net/en/\n",
]


@pytest.mark.parametrize("limit", [100, 1])
def test_urls(spark, limit):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*URLS, *URLS])] + [(None, URLS[5], None)], "page_id long, url string, rule string")
    wanted = Counter((i, *brute.verdict(u)) for i, u in pages.select("page_id", "url").collect())
    assert rows(url_filter.filter_urls(pages, list(url_filter.RULES), max_broadcast=limit)) == wanted
    empty = url_filter.filter_urls(pages.limit(0), list(url_filter.RULES), max_broadcast=limit)
    assert empty.count() == 0


@pytest.mark.parametrize("cell_rows", [4096, 3])
def test_simhash(docs, cell_rows, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    assert rows(simhash.assign(docs)) == Counter(brute.simhash(texts(docs)))


def test_simhash_links_whatever_the_parts(spark):
    """Planted neighbours at every distance are found with two, three and four parts."""
    import random

    import numpy as np

    rng = random.Random(3)
    prints = [rng.getrandbits(64) & rng.getrandbits(64) for _ in range(300)]
    for p in prints[:60]:
        flips = rng.sample(range(64), rng.randint(1, 4))
        prints.append(p ^ sum(1 << b for b in flips))
    prints = sorted(set(prints))
    linked = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    wanted = brute.components(list(range(len(prints))), linked)
    nodes = spark.createDataFrame([(simhash._signed(p), i) for i, p in enumerate(prints)], "fp long, id long")
    counts = simhash.pair_counts(nodes)
    assert counts[5][9] == sum(1 for p in prints if p >> 5 & 1 and p >> 9 & 1)
    for parts in (2, 3, 4):
        groups = simhash.group_bits(counts, len(prints), parts)
        assert sorted(sum(groups, [])) == list(range(64))
        units = {2: [1, 1], 3: [1, 0, 0], 4: [0, 0, 0, 0]}[parts]
        found = simhash.links(simhash.cells(simhash.signatures(nodes, list(zip(groups, units))), 16))
        assert brute.components(list(range(len(prints))), [tuple(r) for r in found.collect()]) == wanted
    assert sum(t + 1 for _, t in simhash.plan(counts, 10**12)) == 4
    assert np.isclose(simhash.close_share(counts, len(prints), list(range(8)), 8)[-1], 1)


def test_simhash_keeps_one(docs):
    left = simhash.keep_one(docs)
    groups = {r.doc_id: r.component_id for r in simhash.assign(docs).collect()}
    named = sorted(d for d, _ in texts(left) if d is not None)
    assert named == sorted({c for c in groups.values() if c is not None})
    assert left.columns == docs.columns


def test_simhash_keeps_different_texts_of_an_id(spark):
    say = lambda name: " ".join(f"{name}{i}" for i in range(60))
    given = [
        (3, say("a")), (7, say("a")), (7, say("b")), (7, say("b")), (7, say("c")), (8, say("c")), (9, say("d")), (9, None),
        (10, say("d")),
    ]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    wanted = [(3, say("a")), (7, say("b")), (7, say("c")), (9, say("d")), (9, None)]
    assert rows(simhash.keep_one(docs)) == Counter(wanted)


@pytest.mark.parametrize(("hot", "small"), [(100_000, 12), (100_000, 1), (3, 12)])
def test_suffix(docs, hot, small, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SMALL_GROUP", small)
    assert rows(suffix_dedup.report(docs, hot=hot)) == Counter(brute.suffix(texts(docs)))


def test_suffix_in_small_pieces(odd, monkeypatch):
    for name, value in (("SEGMENT", 1000), ("RUN_ROWS", 20), ("BUCKET_ROWS", 10)):
        monkeypatch.setattr(suffix_dedup, name, value)
    for length in (30, 64):
        assert rows(suffix_dedup.report(odd, length=length)) == Counter(brute.suffix(texts(odd), length))


@pytest.mark.parametrize(("length", "shorter", "hot", "small"), [(400, 256, 100_000, 12), (64, 30, 100_000, 1), (400, 256, 3, 12)])
def test_suffix_with_shorter_passages(odd, length, shorter, hot, small, monkeypatch):
    for name, value in (("SMALL_GROUP", small), ("SEGMENT", 1000), ("RUN_ROWS", 200), ("BUCKET_ROWS", 100), ("TOLD_ROWS", 3)):
        monkeypatch.setattr(suffix_dedup, name, value)
    given = texts(odd)
    wanted = [(*long, short[2]) for long, short in zip(brute.suffix(given, length), brute.suffix(given, shorter))]
    assert rows(suffix_dedup.report(odd, length=length, hot=hot, shorter=shorter)) == Counter(wanted)


def test_suffix_query_tells_passages_of_over_fifty_words(spark, tmp_path):
    """Passages shorter than the removed strings show in their own column; what is removed is not changed by them."""
    import random

    from tallyhouse.llm import queries

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 6)))
    say = lambda n: " ".join(word() for _ in range(n))
    shared = [say(56) for _ in range(6)]
    assert all(256 < len(p) < 400 for p in shared)
    planted = [(2 * k + i, f"{say(40 + 9 * k)} {p} {say(30)}") for k, p in enumerate(shared) for i in (0, 1)]
    clean = [(100 + k, say(80 + 11 * k)) for k in range(12)]
    given = [*planted, *clean, (200, planted[0][1]), (201, planted[0][1]), (202, None), (203, None), (204, shared[0])]
    spark.createDataFrame(given, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op7_suffix_array(spark, str(tmp_path))
    assert found.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    passages = {r.doc_id: r.n_passage_bytes for r in found.collect()}
    assert all(passages[d] >= 256 for d, _ in planted) and not any(passages[d] for d, _ in clean)
    assert rows(found.select(found.columns[:5])) == Counter(brute.suffix(given))


def test_suffix_text(docs):
    left = suffix_dedup.remove_repeats(docs)
    wanted = Counter()
    for (d, t), data, gone in zip(texts(docs), *brute.removed_bytes(texts(docs))):
        at, kept = 0, []
        for c in t or "":
            size = len(c.encode())
            if not all(i in gone for i in range(at, at + size)):
                kept.append(c)
            at += size
        wanted[d, None if t is None else "".join(kept)] += 1
    assert Counter(texts(left)) == wanted
    assert left.columns == docs.columns


def test_word_windows(docs):
    assert rows(word_windows.report(docs)) == Counter(brute.word_windows(texts(docs)))


def test_word_windows_in_small_chunks(odd, monkeypatch):
    monkeypatch.setattr(word_windows, "CHUNK", 500)
    assert [word_windows.levels(n) for n in (1, 3, 13, 50)] == [[1, 1], [2, 3], [7, 13], [7, 13, 25, 50]]
    for window in (3, 13, 30, 50):
        assert rows(word_windows.report(odd, window)) == Counter(brute.word_windows(texts(odd), window))


def test_word_windows_end_when_none_survive(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(80))) for i in range(5)] + [(9, "w1x1 w1x2 w1x3")], "doc_id long, text string")
    found = word_windows.report(docs, 50)
    assert rows(found) == Counter(brute.word_windows(texts(docs), 50)) and found.agg({"n_removed": "max"}).first()[0] == 0


def test_word_windows_cut_each_text_of_an_id_by_its_own(spark, monkeypatch):
    say = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    shared, other = say("shared", 20), say("other", 18)
    given = [
        (3, shared), (5, other + " " + say("five", 6)), (7, say("a", 40) + " " + shared + " " + say("b", 9)),
        (7, other), (7, say("c", 70)), (7, "short"), (7, None), (9, say("c", 70)), (9, say("c", 30) + " " + other),
    ]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    wanted = Counter(brute.word_windows(given))
    assert rows(word_windows.report(docs.repartition(3))) == wanted
    monkeypatch.setattr(word_windows, "CHUNK", 20)
    assert rows(word_windows.report(docs.coalesce(1))) == wanted


def test_licenses(docs):
    found = licenses.scan_licenses(docs)
    base = found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert rows(base) == Counter((d, *brute.licenses(t)) for d, t in texts(docs))
    method = Counter()
    for d, t in texts(docs):
        labels, score = brute.license_method(t, licenses.RULES)
        own = brute.licenses(t)[-1]
        labels |= set(own.split(",")) if own else set()
        method[d, ",".join(sorted(labels)), max(score, licenses.BASE_CONFIDENCE if own else 0.0)] += 1
    assert rows(found.select("doc_id", "labels", "score")) == method
    for r in found.collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


SIGNED = {
    "Released under the MIT License.": ("mit", 0.9),
    "SPDX-License-Identifier: LGPL-2.1-or-later": ("lgpl", 1.0),
    "Licensed under CC BY-NC 4.0.": ("cc-by,cc-by-nc", 0.9),
    "licensed under the GNU Affero General Public License, version 3": ("agpl", 0.9),
    "This work is licensed under the GNU General Public License, version 3.": ("gpl", 0.9),
    "dual licensed under the Mozilla Public License 2.0": ("mpl", 0.9),
    "mit freundlichen Grüßen": ("", 0.0),
    "the permit license": ("", 0.0),
    "Apache License": ("apache", 0.6),
}


def test_license_signatures(spark):
    docs = spark.createDataFrame(list(enumerate(SIGNED)), "doc_id long, text string")
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(docs).collect()}
    wanted = dict(enumerate(SIGNED.values()))
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in wanted.items()}
    assert all(found[k][1] >= wanted[k][1] - 0.11 for k in wanted)
    assert len(licenses.RULES) > 300


LOST = {
    "SPDX-License-Identifier: AGPL-3.0": "agpl", "SPDX-License-Identifier: EPL-2.0": "epl",
    "SPDX-License-Identifier: GFDL-1.3": "gfdl", "SPDX-License-Identifier: OFL-1.1": "ofl",
    "SPDX-License-Identifier: BSL-1.0": "bsl", "SPDX-License-Identifier: SSPL-1.0": "sspl",
    "licensed under the ODbL": "odbl", "licensed under the PDDL": "pddl",
    "Licensed under the Common Development and Distribution License": "cddl",
    "Licensed under the European Union Public Licence": "eupl", "Released under Creative Commons Zero": "cc0",
    "licenced under the GNU GPL": "gpl", "governed by the GNU GPL": "gpl", "the WTFPL licence": "wtfpl",
    "under the GNU Library General Public License, version 2": "lgpl", "no words of any rule": "",
}


def example(tree, rng):
    """Some text that a parsed expression matches."""
    out = ""
    for op, arg in tree:
        match str(op):
            case "LITERAL":
                out += chr(arg)
            case "IN":
                out += example([rng.choice(arg)], rng)
            case "RANGE":
                out += chr(rng.randint(*arg))
            case "BRANCH":
                out += example(rng.choice(arg[1]), rng)
            case "SUBPATTERN":
                out += example(arg[-1], rng)
            case "MAX_REPEAT":
                out += "".join(example(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))))
            case "NOT_LITERAL":
                out += "z"
            case "ASSERT":
                pass
            case other:
                raise ValueError(other)
    return out


def test_license_gate_changes_no_result(spark):
    import random
    from re import _parser

    rng, rules = random.Random(3), [r._replace(keywords=()) for r in licenses.RULES]
    given = [*LOST, *(example(_parser.parse(r.regex), rng) for r in rules for _ in range(4))]
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(8)
    found = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert {t: found[i].labels for i, t in enumerate(LOST)} == LOST
    assert found == {r.doc_id: r for r in licenses.scan_licenses(docs, rules=rules).collect()}
    assert all(found[i].labels for i in range(len(LOST), len(given)))


BODIES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)": "mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: x": "bsd",
    "Neither the name of the University of X nor the names of its contributors may be used to endorse or promote products derived": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.": "isc",
    "you may not use this file except in compliance with the License. You may obtain a copy": "apache",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published": "gpl",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License": "lgpl",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "permission to use the software is given": "",
}


def test_license_bodies(spark):
    docs = spark.createDataFrame(list(enumerate(BODIES)), "doc_id long, text string")
    found = {r.doc_id: (r.labels.split(",") if r.labels else [], r.score) for r in licenses.scan_licenses(docs).collect()}
    for i, (text, label) in enumerate(BODIES.items()):
        assert (label in found[i][0] and found[i][1] == 0.95) if label else found[i] == ([], 0.0)
        labels, score = brute.license_method(text, licenses.RULES)
        assert (set(found[i][0]) - {"gpl"} == labels - {"gpl"}) and found[i][1] == score


def test_license_scan_of_a_long_text_is_linear(spark):
    """Twenty thousand notices in one text; with work that grows with their square this took a minute."""
    import time

    notice = "licensed under the apache license version 2 "
    docs = spark.createDataFrame([(1, notice * 20_000), (2, "x " + notice * 3)], "doc_id long, text string")
    start = time.perf_counter()
    found = {r.doc_id: (r.n_words, r.n_base, r.labels, r.score) for r in licenses.scan_licenses(docs).collect()}
    assert found == {1: (140_000, 20_000, "apache", 0.9), 2: (22, 3, "apache", 0.9)}
    assert time.perf_counter() - start < 30


def test_simhash_keeps_one_with_any_column_names(spark):
    docs = spark.createDataFrame([(1, "a b c d", 5, 6), (2, "a b c d", 7, 8), (2, "x y z", 9, 1), (None, "a", 1, 1)],
                                 "doc_id long, text string, _fp long, fp long")
    left = simhash.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.where("doc_id IS NOT NULL").collect())) == [(1, "a b c d", 5, 6), (2, "x y z", 9, 1)]
    assert left.count() == 3


@pytest.mark.parametrize("text,shouted", [
    ("AB", 1), ("Ab", 0), ("A", 0), ("A1B!!", 1), ("ÄB C", 0), ("ÄBC", 1), ("AB\tCD ef GH", 3), ("ABc DEF,", 1), ("", 0), (None, 0),
    ("Q" * 200_000 + "q", 0),
])
def test_shouted_words(spark, text, shouted):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.judge(docs).first().n_shouted == shouted


def test_random_rules_by_trie_and_by_join(spark):
    """Rules with equal texts, ties in length, many ends at one place, and hosts below others."""
    import random

    rng = random.Random(4)
    hosts = ["a.b", "b", "c.a.b", "x.b", "net", "a.net"]
    path = lambda: "/" + "/".join("".join(rng.choice("ab") for _ in range(rng.randint(0, 3))) for _ in range(rng.randint(0, 2)))
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), path() + rng.choice(["", "a", "ab", "/"])) for _ in range(250)]
    urls = [(i, f"http://{rng.choice(['', 'w.', 'c.'])}{rng.choice(hosts)}{path()}{rng.choice(['', '?q', 'abb'])}") for i in range(600)]
    pages = spark.createDataFrame([*urls, (None, None), (7, "no")], "page_id long, url string")
    plain = Counter()
    for i, url in pages.collect():
        host, place, _, _ = brute.verdict(url)
        fit = [r for r in map(url_filter.Rule._make, rules) if (host == r.host or host.endswith("." + r.host)) and place.startswith(r.path)]
        won = max(fit, key=lambda r: r.rank, default=None)
        plain[i, host, place, won and won.text, won.verdict if won else "allow"] += 1
    assert rows(url_filter.filter_urls(pages, rules)) == plain
    assert rows(url_filter.filter_urls(pages, rules, max_broadcast=10)) == plain
