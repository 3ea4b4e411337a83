import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, and other scripts."""
    rng = random.Random(5)
    vocabulary = ["the", "of", "and", "le", "der", "é", "ß", "日本", "😀", "a", "Zug", "OK!!", "x|y", "K", "<|endoftext|>"]
    vocabulary += ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage, long = say(200), say(90), say(9000)
    words = base.split()
    near = " ".join([*words[:100], "changed", *words[101:]])
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "ONE two"), (6, base), (7, base), (7, base), (8, near),
        (9, say(60) + " " + passage + " " + say(50)), (10, say(20) + "\n" + passage), (11, passage + passage),
        (12, "aa " * 400), (13, "ab" * 700), (14, "日本語テキスト" * 90), (15, long), (16, say(30) + long[:30000]),
        (17, "line one is here\n" * 30 + say(40)), (18, "\x1f\x00 odd \x85 space\u2028end"), (None, base), (None, None),
        (19, "Licensed under the Apache License, Version 2.0. " + say(15)), (20, "cc by-nc 4.0 and CC BY and MIT License"),
        (21, say(12)), (22, "mit license mit license gnu general public license"), (23, passage[:-1]), (24, near + "!"),
    ]
    return [(i, t, None if k % 3 else "en", None if k % 4 else "src0", None if k % 5 else 7) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns whose names clash with those the operators use."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    names = ("words", "kept", "digest", "fp", "id", "score", "hits", "doc", "n_words", "component_id", "sequence_id", "tid")
    names += ("_fp", "row", "first", "new_text", "rules", "mark", "found", "s", "block", "pair", "label", "toxic")
    return frame.withColumns({n: F.lit(None).cast("string") for n in names})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
