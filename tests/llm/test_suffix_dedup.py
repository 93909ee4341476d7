"""Suffix dedup against a dictionary of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import corpus

from cograph.llm import suffix_dedup as sd


def slow(rows, length):
    raw = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i:i + length] for _, b in raw for i in range(len(b) - length + 1))
    for doc, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        yield doc, len(b), int(gone.sum()), len(sd.runs(gone)[0]), hashlib.sha256(kept).hexdigest()


def check(df, rows, p):
    got = sd.remove_repeats(df, p).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(slow(rows, p.length))


def test_corpus(docs):
    check(docs, corpus(), sd.Repeats())


@pytest.mark.parametrize("alphabet", ["ab", "abcdé😀 "])
def test_random_repeats(spark, alphabet):
    r = random.Random(len(alphabet))
    shared = ["".join(r.choice(alphabet) for _ in range(r.randint(20, 70))) for _ in range(12)]
    rows = [(i, "".join(r.choice([r.choice(shared), "".join(r.choice(alphabet) for _ in range(r.randint(1, 40)))]) for _ in range(r.randint(0, 9)))) for i in range(120)]
    rows += [(500, "ab" * 200), (501, "a" * 300)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), rows, sd.Repeats(length=40, gram=16))


def test_oversized_anchor_groups_and_small_blocks(spark, monkeypatch):
    r = random.Random(11)
    core = "".join(r.choice("abcd") for _ in range(60))
    side = lambda: "".join(r.choice("abcd") for _ in range(r.randint(0, 50)))
    rows = [(i, side() + core[r.randint(0, 20):60 - r.randint(0, 20)] + side()) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    texts = sd.keyed(df)
    p = sd.Repeats(length=24, gram=8)
    check(df, rows, p)
    # every piece as an oversized one: the counted form finds the same starts
    raw = {(x.k1, x.k2): x.text.encode() for x in texts.collect()}
    found = [(k[0], k[1], int(s), int(n), b[s:s + n + p.length - 1]) for k, b in raw.items() for s, n, *_ in zip(*sd.pieces(np.frombuffer(b, np.uint8), p))]
    starts = sd.oversized_starts(spark.createDataFrame(found, "k1 long, k2 long, start long, n long, bytes binary"), p).collect()
    want = sd.repeated_starts(texts, p).collect()
    assert {(x.k1, x.k2, x.start) for x in starts} == {(x.k1, x.k2, i) for x in want for i in range(x.start, x.start + x.n)}


def test_pieces_cover_all_strings_and_depend_on_content():
    r = np.random.default_rng(2)
    p = sd.Repeats(length=50, gram=8)
    text = r.integers(97, 100, 700).astype(np.uint8)
    start, n, anchor, h = sd.pieces(text, p)
    assert start[0] == 0 and (start[1:] == (start + n)[:-1]).all() and start[-1] + n[-1] == 651
    assert ((anchor >= start + n - 1) & (anchor + p.gram <= start + p.length)).all()
    inner = sd.pieces(text[100:400], p)
    whole = {int(s) + i: int(a) for s, m, a in zip(start, n, anchor) for i in range(m)}
    assert all(whole[int(s) + i + 100] == int(a) + 100 for s, m, a in zip(*inner[:3]) for i in range(m))


def test_multikey_quicksort_marks_equal_suffixes():
    r = np.random.default_rng(4)
    data = r.integers(97, 99, 4000).astype(np.uint8)
    for length in (8, 11, 16, 21):
        starts = r.integers(0, 4000 - length, 900)
        groups = r.integers(0, 3, 900)
        keys = [(g, data[s:s + length].tobytes()) for g, s in zip(groups.tolist(), starts.tolist())]
        count = Counter(keys)
        assert sd.repeated(data, starts, groups, length).tolist() == [count[k] > 1 for k in keys]


def test_no_rows(no_docs):
    assert sd.remove_repeats(no_docs).collect() == []
