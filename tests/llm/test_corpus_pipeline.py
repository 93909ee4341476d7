"""The pipeline's stages, each against what it was given."""

import numpy as np
import public_tokenizers
import pytest
from test_packing import reference_ids
from test_simhash import slow_components, slow_fingerprint
from test_substring_dedup import repeated_windows

import corpus_pipeline
from cograph.llm import queries
from cograph.llm.common import scratch_table

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Name -> (input rows, output rows)."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        made = scratch_table(stage(spark, docs, D), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
        out[name] = docs.collect(), made.collect()
        docs = made
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "passages", "packed"]


def test_quality_drops_what_the_classifier_rejects(spark, steps):
    before, after = steps["quality"]
    predicted = {r.doc_id: r.predicted for r in queries.op6_compression_quality(spark, D).collect()}
    assert sorted(after) == sorted(r for r in before if predicted[r.doc_id])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) > 0.9 * len(good)


def test_one_document_of_each_group_stays(steps):
    before, after = steps["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before]
    parts = set(slow_components(rows, [slow_fingerprint(t) for _, t in rows]))
    assert sorted(after) == sorted(r for r in before if r.doc_id in parts)


def test_repeated_passages_go(steps):
    before, after = steps["passages"]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    assert all(r.n_chars == len(r.text) for r in after)
    assert sum(map(len, repeated_windows([(r.doc_id, r.text) for r in after]).values())) <= 0.01 * sum(map(len, repeated_windows([(r.doc_id, r.text) for r in before]).values()))
    touched = repeated_windows([(r.doc_id, r.text) for r in before])
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text == texts[r.doc_id] or r.doc_id in touched or len(r.text) < len(texts[r.doc_id]) for r in after)


def test_all_tokens_are_packed(steps):
    before, after = steps["packed"]
    sizes = dict(zip((r.doc_id for r in before), map(len, reference_ids([r.text for r in before]))))
    found = {}
    for r in after:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == sizes[r.doc_id]
    assert found == sizes
    lengths = np.bincount(np.unique([r.sequence_id for r in after], return_inverse=True)[1], [r.length for r in after])
    assert all(int(n) & (int(n) - 1) == 0 and n <= 2048 for n in lengths)


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(corpus_pipeline.run(spark, D).collect()) == sorted(steps["packed"][1])
    assert public_tokenizers.path("byte_bpe_50k.json")
