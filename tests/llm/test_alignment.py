"""Token alignment against a plain version that moves over the bytes and lists every link."""

import random
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import alignment, queries

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def plain():
    """Ids and bytes of both tokenizers, from their own libraries alone."""
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    codes = {chr(c): c for c in shown} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in shown)}
    a_bytes = lambda i: bytes(codes[c] for c in a.id_to_token(i))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()
    return lambda t: a.encode(t, add_special_tokens=False).ids, a_bytes, b.encode, b_bytes


def given(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ["odd", "sample", "nothing"])
def test_alignment(request, plain, name):
    docs = request.getfixturevalue(name)
    if name == "odd":
        marks = [(50, "a<|endoftext|>b <s> </s> <unk> <0x41>", None, None, None), (51, "\u2581 under  two", None, None, None),
                 (52, "z" * 5000 + "\U0001f600" * 300, None, None, None), (53, "\ufb01 ligature \u00a0 x", None, None, None)]
        more = docs.sparkSession.createDataFrame(marks, "doc_id long, text string, lang string, source string, n_chars long")
        docs = docs.unionByName(more, allowMissingColumns=True)
    wanted = Counter(brute.alignment(given(docs), *plain))
    assert rows(alignment.report(docs, *FILES)) == wanted
    assert rows(alignment.report(docs.repartition(5), *FILES, block_bytes=300)) == wanted


def test_normalised_texts_have_no_tokens(spark):
    docs = spark.createDataFrame([(1, "so \u2581"), (2, "")], "doc_id long, text string")
    assert rows(alignment.report(docs, *FILES)) == Counter([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


def test_pair_counts_and_groups(sample, plain):
    """The translation table and the groups themselves, from the documents' groups."""
    cut = alignment.align(sample, *FILES).collect()
    count = Counter()
    for r in cut:
        assert r.a_ends[-1:] == [len(r.a_ids)][: len(r.a_ends)] and len(r.a_ends) == len(r.b_ends)
        pairs, i, j = set(), 0, 0
        for k, m in zip(r.a_ends, r.b_ends):
            assert b"".join(map(plain[1], r.a_ids[i:k])) == b"".join(map(plain[3], r.b_ids[j:m]))
            pairs |= {(x, y) for x in r.a_ids[i:k] for y in r.b_ids[j:m]}
            i, j = k, m
        count.update(pairs)
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    table = alignment.pair_counts(sample, *FILES)
    assert rows(table) == Counter((a, b, n, n == most[a]) for (a, b), n in count.items())


def test_long_groups_are_multiplied():
    a, b = [5] * 200 + [6], [7] * 90 + [8]
    keys, times = alignment.link_pairs(a, b, [201], [91])
    assert dict(zip(keys.tolist(), times.tolist())) == {5 << 32 | 7: 18000, 5 << 32 | 8: 200, 6 << 32 | 7: 90, 6 << 32 | 8: 1}


def test_query(spark):
    found = queries.op12_token_alignment(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found.count() == docs.count()
    assert found.agg(F.sum("n_groups")).first()[0] > 0


def test_blocks_stay_small(spark):
    """Writers, readers and shuffles hold many blocks at once, so a block is short and its numbers take few bytes."""
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(600))) for i in range(1000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    blocks = alignment.align_blocks(docs, *FILES).select(
        F.size("doc_id").alias("n"), F.aggregate("n_pairs", F.lit(0).cast("long"), lambda a, b: a + b).alias("entries"),
        (F.length("place") + F.length("times")).alias("packed"),
    ).collect()
    assert sum(b.n for b in blocks) == 1000 and len(blocks) > 1
    assert all(b.packed <= 4 * b.entries for b in blocks) and max(b.packed for b in blocks) < 2 << 20


def test_numbers_keep_their_values_in_few_bytes():
    for top, width in ((1, 1), (255, 1), (256, 2), (70_000, 4), (1 << 40, 8)):
        numbers = np.array([0, 1, top])
        packed = alignment._narrow(numbers)
        assert len(packed) == 3 * width and alignment._widen(packed, 3).tolist() == numbers.tolist()
    assert alignment._widen(alignment._narrow(np.zeros(0, dtype=np.int64)), 0).tolist() == []
