"""License scan: ordered signature rules, natively in Spark, one projection and no shuffle.

Texts become lower-case letter words joined by single spaces. A rule is a regular expression with
the keywords a text must have before it is tried, a priority and a confidence. Keywords come in groups of
which any one word must stand in the text; every match has one of each group, so the gate changes no result.
Overlapping detections are resolved by containment: one that lies within a detection of a better
or equal priority is dropped, of two for the same words at equal priority the later label. Labels are those of the remaining detections and of the base phrases,
which are never dropped.

Empty cases: null and empty texts have no words, no labels, null positions and score 0. A null
``doc_id`` stays null; repeated rows are scanned each; an empty table gives an empty result. Very long texts with
many matches take time in proportion to their length. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import NOT_LETTERS, lower_ascii, split_words

# Base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Hand-written names: label, keywords, name as an expression over normalised words, identifier.
# Every alternative of the name, and the identifier, has one of the keywords.
NAMES = r"""
agpl      | affero agpl | gnu affero general public licen[cs]e|agpl                  | agpl
lgpl      | lesser library lgpl | gnu (?:lesser|library) general public licen[cs]e           | lgpl
lgpl      | lgpl       | lgpl                                                        | lgpl
gfdl      | documentation gfdl | gnu free documentation licen[cs]e                        | gfdl
gpl       | gnu gpl    | gnu general public licen[cs]e|gnu gpl                       | gpl
gpl       | gpl        | gpl                                                         | gpl
apache    | apache     | apache(?: software)? licen[cs]e|apache                      | apache
mit       | mit        | mit licen[cs]e|mit                                          | mit
x11       | x11        | x11 licen[cs]e|x11                                          | x11
bsd       | bsd        | (?:[0234] clause |new |modified |simplified |revised )?bsd(?: [0234] clause)?(?: licen[cs]e)? | bsd
isc       | isc        | isc licen[cs]e|isc                                          | isc
mpl       | mozilla mpl | mozilla public licen[cs]e                                   | mpl
mpl       | mpl        | mpl                                                         | mpl
epl       | eclipse epl | eclipse public licen[cs]e                                   | epl
edl       | eclipse edl | eclipse distribution licen[cs]e                             | edl
cddl      | development cddl | common development and distribution licen[cs]e|cddl         | cddl
cpl       | common cpl | common public licen[cs]e                                    | cpl
eupl      | european eupl | european union public licen[cs]e|eupl                       | eupl
artistic  | artistic   | (?:clarified )?artistic licen[cs]e                          | artistic
bsl       | boost bsl  | boost software licen[cs]e                                   | bsl
busl      | business busl | business source licen[cs]e                                  | busl
sspl      | server sspl | server side public licen[cs]e                               | sspl
zlib      | zlib       | zlib(?: libpng)? licen[cs]e|zlib                            | zlib
libpng    | libpng     | libpng licen[cs]e                                           | libpng
unlicense | unlicense  | unlicense                                                   | unlicense
wtfpl     | wtfpl      | wtfpl                                                       | wtfpl
psf       | python psf | python(?: software foundation)? licen[cs]e                  | psf
php       | php        | php licen[cs]e                                              | php
ruby      | ruby       | ruby licen[cs]e                                             | ruby
openssl   | openssl    | openssl licen[cs]e                                          | openssl
postgresql | postgresql | postgresql licen[cs]e                                      | postgresql
ms-pl     | microsoft ms | microsoft public licen[cs]e                                 | ms pl
ms-rl     | microsoft ms | microsoft reciprocal licen[cs]e                             | ms rl
ofl       | font ofl   | sil open font licen[cs]e|open font licen[cs]e               | ofl
odbl      | database odbl | open database licen[cs]e|odbl                               | odbl
pddl      | dedication pddl | public domain dedication and licen[cs]e|pddl                | pddl
cc0       | cc0 creative | cc0|creative commons zero                                   | cc0
cc-by-nc-sa | cc       | cc by nc sa                                                 | cc by nc sa
cc-by-nc-nd | cc       | cc by nc nd                                                 | cc by nc nd
cc-by-nc  | cc         | cc by nc                                                    | cc by nc
cc-by-sa  | cc         | cc by sa                                                    | cc by sa
cc-by-nd  | cc         | cc by nd                                                    | cc by nd
cc-by     | cc         | cc by                                                       | cc by
cc-by-nc-sa | creative cc | creative commons attribution non ?commercial share ?alike    | cc by nc sa
cc-by-nc-nd | creative cc | creative commons attribution non ?commercial no ?deriv(?:s|atives) | cc by nc nd
cc-by-nc  | creative cc | creative commons attribution non ?commercial                | cc by nc
cc-by-sa  | creative cc | creative commons attribution share ?alike                   | cc by sa
cc-by-nd  | creative cc | creative commons attribution no ?deriv(?:s|atives)          | cc by nd
cc-by     | creative cc | creative commons attribution                                | cc by
""".strip().splitlines()

VERSION = r"(?: (?:version|ver|v|rev|revision)? ?v?[0-9]+(?: [0-9]+){0,2})?(?: (?:only|or later|or any later version))?"
TAIL = r"(?: (?:unported|international|generic|licen[cs]e))*"

# Templates in order of priority: name, expression, confidence, any of these keywords besides the name's own.
# {n} is the name, {i} the identifier.
TEMPLATES = (
    ("identifier", r"spdx licen[cs]e identifier {i}" + VERSION, 1.0, ("spdx",)),
    ("link", r"(?:https? )?(?:www )?(?:opensource|gnu|apache|creativecommons|mozilla|eclipse|spdx) org licen[cs]es? (?:{i})" + VERSION, 0.95, ("org",)),
    ("licensed", r"licen[cs]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?(?:{n})" + VERSION + TAIL, 0.9, ("licensed", "licenced")),
    ("released", r"(?:released|distributed|published|provided|available|covered|issued|shared) (?:by |freely )?under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:{n})" + VERSION + TAIL, 0.9, ("under",)),
    ("governed", r"(?:subject to|governed by|see|read|accept) (?:the )?(?:terms of (?:the )?)?(?:{n})" + VERSION + TAIL, 0.7, ("subject", "governed", "see", "read", "accept")),
    ("full text", r"(?:{n})" + VERSION + r" (?:terms and conditions|permission is hereby granted|full text)", 0.8, ()),
    ("dual", r"dual licen[cs]ed under (?:the )?(?:{n})" + VERSION, 0.9, ("dual",)),
    ("named", r"(?:{n})" + VERSION + r" licen[cs]e", 0.6, ("license", "licence")),
    ("version", r"(?:{n}) (?:version|ver|v) ?v?[0-9]+(?: [0-9]+){0,2}", 0.6, ()),
)
BASE_CONFIDENCE = 0.5

# Hand-written sentences of licence bodies and notices: label, a word that every match has, expression.
# They rank before all templates, since they say what the text itself grants.
BODIES = r"""
mit       | hereby     | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit       | portions   | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
bsd       | redistribution | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd       | contributors | neither the name of (?:[^ ]+ ){1,12}nor the names of (?:its|the) contributors may be used to endorse or promote products
bsd       | redistributions | redistributions (?:of source code must retain|in binary form must reproduce) the above copyright notice
isc       | fee        | permission to use copy modify (?:and or|and) distribute this software for any purpose with or without fee is hereby granted
apache    | compliance | you may not use this (?:file|work|software) except in compliance with the licen[cs]e
apache    | apache     | you may obtain a copy of the licen[cs]e at (?:https? )?www apache org licenses license 2 0
apache    | apache     | apache license version 2 0 january 2004
agpl      | affero     | free software you can redistribute it and or modify it under the terms of the gnu affero general public license
lgpl      | library    | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
gpl       | redistribute | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl       | gnu        | you should have received a copy of the gnu general public license along with this (?:program|software)
gpl       | freedom    | the licenses for most (?:software|software and other practical works) are designed to take away your freedom to share and change (?:it|the works)
gfdl      | invariant  | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license (?:[^ ]+ ){0,20}invariant sections
mpl       | mozilla    | this source code form is subject to the terms of the mozilla public license
epl       | eclipse    | this program and the accompanying materials are made available under the terms of the eclipse public license
edl       | eclipse    | this program and the accompanying materials are made available under the terms of the eclipse distribution license
cddl      | distribution | the contents of this file are subject to the terms of the common development and distribution license
bsl       | organization | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
zlib      | liable     | in no event will the authors be held liable for any damages arising from the use of this software
zlib      | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl     | verbatim   | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
cc0       | dedicated  | has dedicated the work to the public domain by waiving all of (?:his or her|their) rights to the work worldwide under copyright law
cc-by     | share      | you are free to share copy and redistribute the material in any medium or format
ofl       | fonts      | the fonts including any derivative works can be bundled embedded redistributed and or sold with any software
artistic  | package    | the intent of this document is to state the conditions under which a package may be copied
postgresql | agreement | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
x11       | consortium | except as contained in this notice the name of the x consortium shall not be used in advertising
openssl   | openssl    | this product includes software developed by the openssl project for use in the openssl toolkit
php       | php        | this product includes php software freely available from
psf       | python     | this license agreement is between the python software foundation
ms-pl     | accompanying | this license governs use of the accompanying software if you use the software you accept this license
busl      | licensor   | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
sspl      | functionality | make the functionality of the program or a modified version available to third parties as a service
""".strip().splitlines()
BODY_CONFIDENCE = 0.95


class Rule(NamedTuple):
    label: str
    keywords: tuple[tuple[str, ...], ...]
    regex: str
    priority: int
    confidence: float


def _rules() -> list[Rule]:
    """The bodies, then every name under every template. Names that say more stand first within a template."""
    names = [[c.strip() for c in re_split(line)] for line in NAMES]
    bodies = [[c.strip() for c in re_split(line)] for line in BODIES]
    return [
        Rule(label, ((word,),), f"(?<= )(?:{regex})(?= )", 0, BODY_CONFIDENCE) for label, word, regex in bodies
    ] + [
        # Whole words only: the text has a space on both sides of each word.
        Rule(label, (tuple(own.split()), more) if more else (tuple(own.split()),), "(?<= )(?:" + shape.replace("{n}", name).replace("{i}", ident) + ")(?= )", t, sure)
        for t, (_, shape, sure, more) in enumerate(TEMPLATES, 1)
        for label, own, name, ident in names
    ]


def re_split(line: str) -> list[str]:
    """Columns of the table are set off by a bar between spaces; alternatives have none around theirs."""
    return line.split(" | ")


RULES = _rules()


def _keywords(rules: list[Rule]) -> list[str]:
    return sorted({k for r in rules for group in r.keywords for k in group} | {w for p, _ in BASE for w in p.split()})


def _phrase_starts(words: Column, phrase: str) -> Column:
    """Word indexes at which the phrase's words stand consecutively."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    where = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def here(i: Column) -> Column:
        test = F.get(words, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            test = test & (F.get(words, i + j) == part)
        return test

    return F.filter(where, here)


# Stand before and behind a detection; no word contains them.
_OPEN, _CLOSE = "\x01", "\x02"


def _detections(text: Column, rule: Column) -> Column:
    """Detections of one rule: first word, last word (negated, so that longer sorts first), priority, label.

    The matches are marked in the text, whose words then tell their own places: the first words and the last
    words of the matches come in the same order. So the work grows with the text, however many matches it has.
    """
    marked = F.regexp_replace(text, rule["regex"], F.lit(f"{_OPEN}$0{_CLOSE}"))

    def places(words: Column, mark: Column) -> Column:
        return F.filter(F.transform(words, lambda w, i: F.when(F.contains(w, mark), i - 1)), lambda i: i.isNotNull())

    def pairs(words: Column) -> Column:
        # The text begins with a space, so its first word is the second part.
        return F.zip_with(
            places(words, F.lit(_OPEN)), places(words, F.lit(_CLOSE)),
            lambda first, last: F.struct(
                first.alias("first"), (-last).alias("minus_last"), rule["priority"].alias("priority"),
                rule["label"].alias("label"), rule["confidence"].alias("confidence"),
            ),
        )

    # As an array of one, so that the marked text is made once.
    hit = F.filter(F.array(marked), lambda m: F.contains(m, F.lit(_OPEN)))
    return F.flatten(F.transform(F.transform(hit, lambda m: F.split(m, " ")), pairs))


def _resolve(sorted_detections: Column) -> Column:
    """Labels and best confidence of the detections that no better-ranked one contains.

    In order of first word, longer first, the detections seen so far start no later than the
    current one. So it is contained in one of a better or equal priority exactly if the furthest
    last word of those reaches its own: one number per priority is the whole state.
    """
    n = 1 + len(TEMPLATES)
    begin = F.struct(
        F.array_repeat(F.lit(-1), n).alias("reach"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("best"),
    )

    def step(acc: Column, d: Column) -> Column:
        last = -d["minus_last"]
        inside = F.exists(F.slice(acc["reach"], 1, d["priority"] + 1), lambda r: r >= last)
        return F.struct(
            F.transform(
                acc["reach"], lambda r, i: F.when(i == d["priority"], F.greatest(r, last)).otherwise(r)
            ).alias("reach"),
            F.when(inside, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(d["label"]))).alias("labels"),
            F.when(inside, acc["best"]).otherwise(F.greatest(acc["best"], d["confidence"])).alias("best"),
        )

    return F.aggregate(sorted_detections, begin, step)


def _rule_table(rules: list[Rule]) -> Column:
    """The rules as one literal; built column by column, hundreds of them take seconds."""
    kind = "array<struct<label:string,keywords:array<array<string>>,regex:string,priority:int,confidence:double>>"
    return F.from_json(F.lit(json.dumps([r._asdict() for r in rules])), kind)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: list[Rule] = RULES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` per row."""
    none = F.array().cast("array<string>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    frame = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # lower() also changes letters beyond A-Z, but it never ends or joins a word, so counts hold and
    # the gate lets through at least what it must; gated texts are lower-cased exactly below.
    frame = frame.withColumn("rough", split_words(F.lower("text"), NOT_LETTERS))
    frame = frame.select(
        "doc_id", "text", F.size("rough").cast("long").alias("n_words"),
        F.array_intersect("rough", F.array(*map(F.lit, _keywords(rules)))).alias("found"),
    )
    # A rule without keywords is tried on every text.
    scanned = F.size("found") > 0 if all(r.keywords for r in rules) else F.lit(True)
    frame = frame.select(
        "doc_id", "n_words", "found",
        F.when(scanned, split_words(lower_ascii(F.col("text")), NOT_LETTERS)).otherwise(none).alias("words"),
    )
    wanted = F.filter(
        _rule_table(rules),
        lambda r: F.forall(r["keywords"], lambda group: F.exists(group, lambda k: F.array_contains("found", k))),
    )
    frame = frame.select(
        "doc_id", "n_words",
        *[_phrase_starts(F.col("words"), p).alias(f"base_{i}") for i, (p, _) in enumerate(BASE)],
        F.when(scanned, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))).alias("norm"),
        F.when(scanned, wanted).alias("rules"),
    )
    starts = [F.col(f"base_{i}") for i in range(len(BASE))]
    base_labels = [F.when(F.size(s) > 0, F.lit(label)) for s, (_, label) in zip(starts, BASE)]
    found = F.flatten(F.transform("rules", lambda r: _detections(F.col("norm"), r)))
    frame = frame.select(
        "doc_id", "n_words", F.concat(*starts).alias("places"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*base_labels)))).alias("base"),
        F.when(F.size("rules") > 0, F.array_sort(found)).alias("detections"),
    )
    frame = frame.withColumn("kept", F.when(F.size("detections") > 0, _resolve(F.col("detections"))))
    any_base = F.when(F.size("places") > 0, F.lit(BASE_CONFIDENCE)).otherwise(0.0)
    return frame.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("kept.labels", none))), ",").alias("labels"),
        F.greatest(any_base, F.coalesce("kept.best", F.lit(0.0))).alias("score"),
    )
