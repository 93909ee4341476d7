"""Winnowing against a direct implementation."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import corpus

from cograph.llm import winnowing as wn


def slow_winnow(text, p):
    if not text:
        return []
    k = min(p.k, len(text))
    hashes = []
    for i in range(len(text) - k + 1):
        h = 0
        for c in text[i:i + k]:
            h = (h * wn.BASE + ord(c) + 1) % (1 << 64)
        hashes.append(((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) % (1 << 64) >> 32)
    w = min(p.w, len(hashes))
    out = []
    for i in range(len(hashes) - w + 1):
        least = min(hashes[i:i + w])
        at = max(j for j in range(i, i + w) if hashes[j] == least)
        if not out or out[-1] != (least, at):
            out.append((least, at))
    return out


@pytest.mark.parametrize("k,w", [(1, 1), (5, 4), (20, 64), (7, 13), (3, 2), (16, 8)])
def test_winnow(k, w):
    r = random.Random(k * w)
    for _ in range(25):
        text = "".join(r.choice("ab é😀") for _ in range(r.randint(0, 150)))
        hashes, at = wn.winnow(wn.code_points(text), wn.Winnowing(k, w))
        assert list(zip(hashes.tolist(), at.tolist())) == slow_winnow(text, wn.Winnowing(k, w))


def test_common_runs_leave_a_common_hash():
    r = random.Random(3)
    p = wn.Winnowing(8, 16)
    for _ in range(100):
        run = "".join(r.choice("abc") for _ in range(p.w + p.k - 1))
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 80))) + run + "".join(r.choice("abc") for _ in range(r.randint(0, 80))) for _ in range(2))
        assert set(wn.winnow(wn.code_points(a), p)[0].tolist()) & set(wn.winnow(wn.code_points(b), p)[0].tolist())


def test_half_of_a_short_text_leaves_a_common_hash():
    r = random.Random(4)
    for n in range(46, 170):
        text, other = ("".join(r.choice("abcdefgh ") for _ in range(n)) for _ in range(2))
        edited = text[:n - n // 2] + other[:n // 2]
        a, b = (wn.winnow(wn.code_points(t), wn.Winnowing())[0] for t in (text, edited))
        assert wn.likeness(a, b) > 0, n


def ordered(rows):
    rows = [(d, t or "") for d, t in rows]
    return sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))


def expected(rows, p=wn.Winnowing()):
    rows = ordered(rows)
    print_ = lambda t: np.array([h for h, _ in slow_winnow(t, p)], np.uint32)
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = print_(text), print_(edited), print_(after)
        yield doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.astype(">u4").tobytes(), b.astype(">u4").tobytes(), wn.likeness(a, b), wn.likeness(a, c)


def test_edited_fingerprints(docs):
    rows = [r for r in corpus() if len(r[1] or "") < 5000]
    got = wn.edited_fingerprints(docs.filter("text is null or length(text) < 5000")).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, bytes(r.hashes), bytes(r.edited_hashes), r.near_edited, r.near_next) for r in got) == Counter(expected(rows))


def test_order_holds_across_buckets(docs):
    rows = wn.with_next(docs, rows_per_bucket=3).collect()
    assert len({r.bucket for r in rows}) > 5
    got = sorted(((r.bucket, r.lead, r.doc_id is None, -(r.doc_id or 0), r.text) for r in rows))
    assert [(None if g[2] else -g[3], g[4]) for g in got if not g[1]] == ordered(corpus())
    leads = {g[0]: (g[2], g[3], g[4]) for g in got if g[1]}
    buckets = sorted(leads)
    for b, after in zip(buckets, [*buckets[1:], buckets[0]]):
        assert leads[b] == next(g[2:] for g in got if g[0] == after and not g[1])


def test_one_row_and_none(spark, no_docs):
    assert wn.edited_fingerprints(no_docs).collect() == []
    r = wn.edited_fingerprints(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).collect()[0]
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_long_text_and_positions(docs):
    r = wn.fingerprints(docs.filter("doc_id = 6")).collect()[0]
    text = dict(corpus())[6]
    hashes, at = wn.winnow(wn.code_points(text), wn.Winnowing())
    assert r.hashes == hashes.tolist() and r.positions == at.tolist()
    assert max(np.diff(at)) <= 64
