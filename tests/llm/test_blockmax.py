"""Block-Max MaxScore against a full scan."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import words

from cograph.llm import blockmax

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def full_scan(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, query in asked.items():
        scores = []
        for doc, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // max(total, 1)
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in query.items() if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def make_shard(texts, query_terms, n=None, total=None):
    number = {t.encode(): i for i, t in enumerate(query_terms)}
    row = blockmax.shard_row(pa.table({"doc_id": pa.array([i for i, _ in texts], pa.int64()), "text": pa.array([t for _, t in texts])}), number)
    return blockmax.Shard(row, n or row["n_docs"], total or row["n_terms"]), row


@pytest.mark.parametrize("size", [1, 2, 127, 128, 129, 1000])
def test_blocks_round_trip(size):
    r = np.random.default_rng(size)
    for top, most in ((300, 3), (70_000, 300), (2**31 - 1, 100_000)):
        docs = np.unique(r.integers(0, top, size))
        counts = r.integers(1, most + 1, len(docs))
        got = blockmax.decompress(blockmax.compress(docs, counts), int(docs[0]))
        assert np.array_equal(got[0], docs) and np.array_equal(got[1], counts)


def test_terms():
    text = "It's A-b  É9Ünß 漢字,\x00x\x7fy_Z " + "q" * 50
    assert [t.decode() for ts in blockmax.terms_of(text.encode()) for t in ts] == terms(text)


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(blockmax, "CHUNK", 16)
    for text in ("ab " * 50, "x" * 100 + " y", "é" * 40, "", "...", "a" * 16 + " b", "a" * 15 + "  " + "b" * 40 + " c"):
        assert [t.decode() for ts in blockmax.terms_of(text.encode()) for t in ts] == terms(text)


def test_rejected_blocks_stay_compressed():
    """A common term's blocks are opened only where its bound can still lift a document."""
    r = random.Random(3)
    texts = [(i, " ".join(["common"] * r.randint(1, 3) + ["filler"] * r.randint(5, 60) + ["rare"] * (i in (5, 4500, 20_000)))) for i in range(20_001)]
    shard, row = make_shard(texts, ["common", "rare"])
    df = dict(zip(row["terms"].tolist(), row["counts"].tolist()))
    assert df == {0: 20_001, 1: 3}
    best = blockmax.Best(2)
    shard.search([(0, 1), (1, 9000)], best)
    assert best.ids.tolist() and set(best.ids.tolist()) <= {5, 4500, 20_000}
    common = range(*shard.lists[0])
    opened = [b for b in common if b in shard.open]
    assert len(opened) < len(common) / 2


@pytest.mark.parametrize("seed", range(4))
def test_a_shard_is_exact(seed, monkeypatch):
    monkeypatch.setattr(blockmax, "SPAN", 64)
    monkeypatch.setattr(blockmax, "POSTINGS", 8)
    r = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(40)]
    texts = [(r.randrange(10**6), " ".join(r.choices(vocabulary, [1 / (i + 1) ** 1.5 for i in range(40)], k=r.randint(0, 60)))) for _ in range(900)]
    shard, row = make_shard(texts, vocabulary)
    df = dict(zip(row["terms"].tolist(), row["counts"].tolist()))
    for _ in range(12):
        query = Counter(r.choices(vocabulary, k=r.randint(1, 9)))
        best = blockmax.Best(7)
        shard.search([(vocabulary.index(t), c * blockmax.term_weight(row["n_docs"], df.get(vocabulary.index(t), 0))) for t, c in query.items()], best)
        want = full_scan(texts, [(0, " ".join(query.elements()))], 7)
        assert sorted((0, i, d, s) for i, (d, s) in enumerate(zip(best.ids.tolist(), best.scores.tolist()), 1)) == sorted(want)


def test_search(spark, docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, words(1, 20)), (2, words(7, 12)), (3, None), (4, ""), (5, "nobody has this"), (6, words(6, 40)), (6, words(6, 3)), (None, words(9, 10)), (7, "A a ab x" + " x" * 500), (8, "漢字 DON'T")]
    asked = spark.createDataFrame([(*x, "clash", 3) for x in items], "item_id long, text string, doc_id string, score int")
    for k in (3, 20):
        got = blockmax.search(docs, asked, k)
        assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
        assert sorted(map(tuple, got.collect()), key=str) == full_scan(rows, items, k)
    monkeypatch.setattr(blockmax, "QUERY_TERMS", 25)  # several blocks of items
    assert sorted(map(tuple, blockmax.search(docs, asked, 3).collect()), key=str) == full_scan(rows, items, 3)


def test_copies_hold_a_third_of_all_rows(spark):
    rows = [(3000 - i, words(1, 30)) for i in range(1000)] + [(i, words(i, 40)) for i in range(10_000, 12_000)]
    items = [(0, words(1, 30)), (1, words(10_005, 9)), (2, words(2, 4))]
    got = blockmax.search(spark.createDataFrame(rows, "doc_id long, text string").repartition(9), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == full_scan(rows, items, 20)


def test_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert blockmax.search(no_docs, items).collect() == [] and blockmax.search(docs, items.limit(0)).collect() == []
