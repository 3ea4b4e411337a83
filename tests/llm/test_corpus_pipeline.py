"""All stages of the pipeline against the plain versions, each on what its predecessor kept."""

from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import quality
from tallyhouse.session import materialise

SF = "/root/testdata/sf0.001"


def texts(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def edited(docs):
    out = []
    for (d, t), data, gone in zip(docs, *brute.removed_bytes(docs, corpus_pipeline.PASSAGE_BYTES)):
        at, kept = 0, []
        for c in t or "":
            size = len(c.encode())
            kept.append("" if all(i in gone for i in range(at, at + size)) else c)
            at += size
        out.append((d, "".join(kept)))
    return out


@pytest.mark.parametrize("source", ["sample", "odd", "nothing"])
def test_stages(spark, source, request):
    # The odd rows have further columns, with names that the operators use themselves.
    docs = request.getfixturevalue(source)
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = texts(docs)
        docs = materialise(stage(spark, docs, SF), "test")
        kept[name] = (before, texts(docs) if name != "packing" else docs.collect())
        if name != "packing":
            assert docs.columns == columns
        if name == "suffix_array":
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0

    before, after = kept["quality"]
    failed = {t for _, t in before if brute.quality(t)[-1]}
    assert not failed & {t for _, t in after}
    method = {r.doc.text for r in quality.judge(request.getfixturevalue(source)).collect() if not r.kept}
    assert Counter(after) == Counter(r for r in before if r[1] not in method)

    before, after = kept["simhash"]
    stay = {c for _, _, c in brute.simhash(before)}
    assert sorted(d for d, _ in after if d is not None) == sorted(x for x in stay if x is not None)
    assert set(after) <= set(before)

    before, after = kept["suffix_array"]
    assert Counter(after) == Counter(edited(before))

    before, after = kept["decontamination"]
    items = texts(spark.read.parquet(f"{SF}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    verdicts = brute.decontaminate(before, items)
    assert Counter(after) == Counter(r for r, (*_, dirty) in zip(before, verdicts) if not dirty)

    before, pieces = kept["packing"]
    assert {p.doc_id for p in pieces} == {d for d, _ in before}
    whole = Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0)
    assert sum(n * t for (_, t), n in whole.items()) == sum(p.length for p in pieces)


def test_run_equals_its_stages(spark):
    result = corpus_pipeline.run(spark, SF)
    assert result.count() > 0 and result.columns[:3] == ["doc_id", "start", "length"]
