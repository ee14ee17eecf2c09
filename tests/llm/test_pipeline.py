"""The stages of the pipeline, each against a plain computation on its own input."""

import corpus_pipeline
from costalloc.llm.common import materialize
from tests.conftest import SMALL
from tests.llm import test_decontam, test_packing, test_simhash, test_substrings


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    after = {}
    for name, function in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(function(spark, docs, SMALL), "stage")
        after[name] = (before.collect(), docs.collect())
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert len(stage) == 5

    before, kept = after["quality rules"]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept}
    assert set(kept) <= set(before) and len(ids) == len(kept)
    junk = [d for d, r in labels.items() if r.quality == 0]
    assert sum(d not in ids for d in junk) >= 0.8 * len(junk)

    before, kept = after["SimHash near-dedup"]
    roots = test_simhash.plain_components([(r.doc_id, test_simhash.plain_fingerprint(r.text)) for r in before])
    assert {r.doc_id for r in kept} == {d for d, root in roots.items() if d == root} and set(kept) <= set(before)

    before, kept = after["substring dedup"]
    plain = {r[0]: r for r in test_substrings.plain([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id for r in kept} == {d for d, r in plain.items() if not r[2] or r[2] < r[1]}
    for r in kept:
        words = r.text.encode().split()
        assert len(words) == plain[r.doc_id][1] - plain[r.doc_id][2] and r.n_chars == len(r.text)

    before, kept = after["benchmark decontamination"]
    items = [test_decontam.tokens(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    seeds = [{tuple(i[k : k + 5]) for k in range(len(i) - 4)} for i in items]
    leaked = set()
    for r in before:
        words = test_decontam.tokens(r.text)
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for item, some in zip(items, seeds, strict=True):
            if own & some and test_decontam.plain_covered(item, words) >= 0.5 * len(item):
                leaked.add(r.doc_id)
    assert {r.doc_id for r in kept} == {r.doc_id for r in before} - leaked

    before, pieces = after["packing"]
    test_packing.check(pieces, [(r.doc_id, r.text) for r in before])


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = materialize(function(spark, docs, SMALL), "stage")
    assert docs.count() == 0


def test_odd_rows(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", "en", None, None), (2, "good words of text " * 9, None, "s", 1), (2, "good words of text " * 9, None, "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    for _, function in corpus_pipeline.STAGES:
        docs = materialize(function(spark, docs, SMALL), "stage")
    assert docs.count() >= 0
