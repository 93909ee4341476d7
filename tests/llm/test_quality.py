"""Compression classifier: held-out accuracy, and the cases without data."""

import math
import random
import zlib

import numpy as np
import pytest
import zstandard
from llm_cases import words

from cograph.llm import compression_quality as cq
from cograph.llm.queries import op6_compression_quality


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = op6_compression_quality(spark, d).collect()
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    good, bad = ([r.score for r in held if labels[r.doc_id] == q] for q in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.9
    assert sum(s >= 0.3 for s in good) / len(good) > 0.95


def test_edge_rows_are_scored(spark, docs):
    labels = spark.createDataFrame([(d, q, "x") for d, q in [(0, 1), (4, 1), (4, 0), (6, 1), (9, 1), (13, 0), (14, 0), (None, 1), (7, None), (99999, 1), (15, 0)]], "doc_id long, quality int, score string")
    got = cq.score_quality(docs, cq.fit_quality(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (1, 2)}
    assert len(empty) == 1


def test_labels_of_the_held_out_fold_change_nothing(spark, docs):
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(0, 1), (4, 1), (13, 0), (14, 0), (6, 1)]
    a = cq.fit_quality(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    b = cq.fit_quality(docs, spark.createDataFrame([r for r in rows if r[0] not in held] + [(i, 0) for i in held], "doc_id long, quality int"))
    assert (a.good, a.bad, a.slope, a.offset) == (b.good, b.bad, b.slope, b.offset)


def test_scores_by_hand(spark, monkeypatch):
    """Dictionaries from the chunks of whole texts, sizes by the library, the curve at its optimum."""
    r = random.Random(3)
    good, bad = ([words(q * 1000 + i, 60 + (500 if i == 3 else 0)) if q else "".join(r.choices("xyz!? ", k=300)) for i in range(40)] for q in (1, 0))
    rows = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1 if i < 40 else 0) for i, _ in rows], "doc_id long, quality int")
    seen = []
    real = cq._dictionary
    monkeypatch.setattr(cq, "_dictionary", lambda chunks, size: seen.append(chunks) or real(chunks, size))
    fit = cq.Fit(dictionary_rows=15, curve_rows=30)
    model = cq.fit_quality(docs, labels, fit)
    text = dict(rows)
    learned = {q: [i for i, _ in rows if (i < 40) == q and zlib.crc32(str(i).encode()) % 5] for q in (True, False)}
    for q, chunks in zip((True, False), seen):
        owners = [i for i in learned[q] if any(c in text[i] for c in chunks)]
        assert len(owners) == 15 and sum(map(len, chunks)) == sum(len(text[i]) for i in owners)  # whole texts, none of the held-out fold

    def difference(t):
        sizes = []
        for raw in (model.good, model.bad):
            z = zstandard.ZstdCompressor(level=fit.level, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=False, write_checksum=False, write_dict_id=False)
            data = t.encode()
            sizes.append(sum(len(z.compress(data[i:i + fit.chunk_bytes])) for i in range(0, len(data), fit.chunk_bytes)))
        return (sizes[1] - sizes[0]) / (sizes[1] + sizes[0])

    got = {x.doc_id: (x.difference, x.score) for x in cq.score_quality(docs, model).collect()}
    for i, t in rows:
        assert got[i][0] == pytest.approx(difference(t))
        assert got[i][1] == pytest.approx(1 / (1 + math.exp(-(got[i][0] * model.slope + model.offset))))
    assert min(got[i][1] for i in range(40)) > max(got[i][1] for i in range(40, 80))
    x, y, w = np.array([0.1, 0.3, 0.2, -0.4, 0.25]), np.array([1.0, 1, 0, 0, 1]), np.array([1.0, 2, 1, 1, 0.5])
    slope, offset = cq._curve(x, y, w)
    p = 1 / (1 + np.exp(-(x * slope + offset)))
    assert abs((w * (y - p) * x * 100).sum() - 1e-3 * slope / 100) < 1e-6 and abs((w * (y - p)).sum() - 1e-3 * offset) < 1e-6


def test_no_rows_and_no_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = cq.fit_quality(no_docs, labels)
    assert cq.score_quality(no_docs, model).collect() == []
    assert {r.score for r in cq.score_quality(docs, model).collect()} == {0.5}
    kept = cq.keep_good(docs, model, 0.5)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert cq.keep_good(docs, model, 0.6).count() == 0
