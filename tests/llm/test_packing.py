"""Packing: tokens against the tokenizer itself, and a partition of all tokens without padding."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from llm_cases import corpus, words
from tokenizers import Tokenizer

from cograph.llm import packing

FILE = public_tokenizers.path("byte_bpe_50k.json")


def reference_ids(texts):
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def check(rows, pieces, window=2048):
    """Pieces of one document put together are its ids; sequences are gapless and unpadded."""
    left = defaultdict(int)
    for (doc, _), ids in zip(rows, reference_ids([t for _, t in rows])):
        left[doc, tuple(ids)] += 1
    by_sequence = defaultdict(list)
    by_doc = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append((p.start, p.doc_tokens, ids))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
    want = defaultdict(list)
    for (doc, ids), n in left.items():
        want[doc] += [list(ids)] * n
    for doc, found in by_doc.items():
        if len(want[doc]) == 1:
            assert [i for _, _, ids in sorted(found) for i in ids] == want[doc][0]
            assert {n for _, n, _ in found} == {len(want[doc][0])}
        assert sum(len(x[2]) for x in found) == sum(map(len, want[doc]))
    assert set(by_doc) == set(want)
    return by_sequence


def test_every_token_once(docs):
    check(corpus(), packing.pack(docs, FILE).collect())


def test_small_windows_and_shards(docs):
    p = packing.Packing(window=64, shard_tokens=3000, query_terms=4)
    by_sequence = check(corpus(), packing.pack(docs, FILE, p).collect(), 64)
    full = [s for s in by_sequence.values() if sum(n for _, n in s) == 64]
    assert len(full) > 0.9 * len(by_sequence)


def test_no_rows(no_docs):
    assert packing.pack(no_docs, FILE).collect() == []


def test_neighbours_share_rare_terms():
    r = np.random.default_rng(2)
    topics = [r.integers(1000 * k, 1000 * k + 50, (30, 60)) for k in range(1, 9)]
    ids = [np.concatenate((t, r.integers(0, 20, 40))).astype(np.uint32) for topic in topics for t in topic]
    order = r.permutation(len(ids))
    ids = [ids[i] for i in order]
    topic = order // 30
    df = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=10_000)
    idf = np.log1p((len(ids) - df + 0.5) / (df + 0.5))
    pieces = packing.fill([len(x) for x in ids], packing.Shard(ids, idf, 100.0, packing.Packing()), 512)
    by_sequence = defaultdict(set)
    for d, _, _, s, _ in pieces:
        by_sequence[s].add(int(topic[d]))
    assert np.mean([len(x) for x in by_sequence.values()]) < 1.6


def test_scores_are_bm25():
    ids = [np.array(x, np.uint32) for x in ([1, 1, 2, 5], [1, 3], [2, 2, 2, 9, 9, 9, 9], [5, 1])]
    idf, mean, p = np.arange(10) / 3, 3.75, packing.Packing()
    shard = packing.Shard(ids, idf, mean, p)
    shard.unused[0] = False

    def score(q, d):
        return sum(idf[t] * (tf := ids[d].tolist().count(t)) * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * len(ids[d]) / mean)) for t in set(ids[q].tolist()))

    want = sorted((d for d in (1, 2, 3) if score(0, d) > 0), key=lambda d: (-score(0, d), d))
    assert list(shard.neighbours(0)) == want


def test_a_seed_asks_with_all_its_terms():
    """Its 16 heaviest terms are its own alone; the neighbours share the others."""
    idf = np.concatenate((np.full(50, 1.0), np.full(50, 9.0)))
    ids = [np.array([*range(50, 70), 1, 2, 3], np.uint32), np.array([70, 1], np.uint32), np.array([71, 1, 2, 3], np.uint32), np.array([72, 9], np.uint32)]
    shard = packing.Shard(ids, idf, 8.0, packing.Packing())
    shard.unused[0] = False
    assert list(shard.neighbours(0)) == [2, 1]


def test_statistics_cover_the_corpus(docs):
    got = packing.document_frequencies(packing.tokenized(docs, FILE, 1))
    want = np.bincount(np.concatenate([np.unique(x) for x in reference_ids([t for _, t in corpus()])]), minlength=len(got))
    assert (got == want).all()


def test_lexical_neighbours_share_a_shard(spark):
    """Topics of four texts among many shards: texts of a topic meet far more often than by chance."""
    rows = []
    for topic in range(120):
        own = words(40_000 + topic, 60).split()
        for i in range(4):
            r = random.Random(topic * 10 + i)
            rows.append((topic * 4 + i, " ".join(r.sample(own, 50) + words(90_000 + topic * 4 + i, 10).split())))
    random.Random(1).shuffle(rows)
    p = packing.Packing(window=256, shard_tokens=8000)
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), FILE, p).collect()
    check(rows, pieces, 256)
    shard = {x.doc_id: x.sequence_id >> 32 for x in pieces}
    assert len(set(shard.values())) > 8
    together = [shard[t * 4] == shard[t * 4 + i] for t in range(120) for i in (1, 2, 3)]
    assert np.mean(together) > 0.3  # by chance one in as many as there are shards


def test_dropping_used_documents_changes_no_window(monkeypatch):
    r = np.random.default_rng(5)
    ids = [np.append(r.zipf(1.3, r.integers(1, 400)) % 900, 1).astype(np.uint32) for _ in range(400)]
    df = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=901)
    idf, mean, p = packing._idf(df, len(ids)), float(np.mean([len(x) for x in ids])), packing.Packing(window=512)
    sizes = [len(x) for x in ids]
    shard = packing.Shard(ids, idf, mean, p)
    dropped = packing.fill(sizes, shard, p.window)
    assert shard.held < len(ids) / 50 and len(shard.docs) < 1000

    def keep(self, doc):
        self.unused[doc] = False

    monkeypatch.setattr(packing.Shard, "take", keep)
    assert packing.fill(sizes, packing.Shard(ids, idf, mean, p), p.window) == dropped


def test_rows_of_frequent_terms_rank_as_lists_do(monkeypatch):
    """Ties included: a seventh of the documents are copies of others."""
    r = np.random.default_rng(6)
    ids = [np.append(r.zipf(1.3, r.integers(1, 300)) % 900, 1).astype(np.uint32) for _ in range(300)]
    ids += [ids[i] for i in r.integers(0, 300, 50)]
    df = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=901)
    idf, mean, p = packing._idf(df, len(ids)), float(np.mean([len(x) for x in ids])), packing.Packing(window=512)
    sizes = [len(x) for x in ids]
    shard = packing.Shard(ids, idf, mean, p)
    assert len(shard.rows) and len(shard.docs)
    ranked = [list(shard.neighbours(d)) for d in range(0, 350, 7)]
    filled = packing.fill(sizes, shard, p.window)
    monkeypatch.setattr(packing.Shard, "DENSE", 0)
    lists = packing.Shard(ids, idf, mean, p)
    assert not len(lists.rows)
    assert [list(lists.neighbours(d)) for d in range(0, 350, 7)] == ranked
    assert packing.fill(sizes, lists, p.window) == filled


def test_neighbours_break_ties_by_number():
    """More documents with one score than the first look takes."""
    ids = [np.array([5, 6, 1], np.uint32)] + [np.array([5, 1], np.uint32) for _ in range(40)]
    df = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=8)
    shard = packing.Shard(ids, packing._idf(df, 41), 2.0, packing.Packing())
    shard.take(0)
    assert list(shard.neighbours(0)) == list(range(1, 41))
