"""SimHash near-dedup against brute force."""

import re
from collections import Counter

import numpy as np
import xxhash

from cograph.llm import simhash
from cograph.llm.queries import op10_simhash
from llm_cases import corpus, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows, fps):
    """Smallest id of each fingerprint's component."""
    distinct = sorted(set(fps))
    owner = {f: f for f in distinct}

    def root(f):
        while owner[f] != f:
            f = owner[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                owner[root(b)] = root(a)
    least = {}
    for (doc, _), f in zip(rows, fps):
        if doc is not None:
            least[root(f)] = min(doc, least.get(root(f), doc))
    return [least.get(root(f)) for f in fps]


def test_matches_brute_force(docs):
    rows = corpus()
    fps = [slow_fingerprint(t) for _, t in rows]
    got = simhash.near_duplicates(docs).collect()
    want = zip((d for d, _ in rows), fps, slow_components(rows, fps))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == Counter(want)


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.keep_one(no_docs).columns == no_docs.columns


def test_keep_one_with_repeated_and_missing_ids(spark):
    """Different texts stay whatever their ids, near copies go whatever theirs."""
    long = [words(900 + i, 80) for i in range(4)]
    rows = [(1, long[0], "a"), (1, long[1], "b"), (None, long[2], "c"), (None, long[2], "d"), (None, long[3], "e"), (9, long[3], "f"), (5, long[0], "g"), (1, long[0], "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string").repartition(3)
    kept = [tuple(r) for r in simhash.keep_one(df).collect()]
    assert sorted((i, t) for i, t, _ in kept if i is not None) == sorted([(1, long[0]), (1, long[1]), (9, long[3])])
    assert [(i, t) for i, t, _ in kept if i is None] == [(None, long[2])]
    assert sorted(map(str, kept)) == sorted(str(tuple(r)) for r in simhash.keep_one(df.coalesce(1)).collect())


def test_keep_one_keeps_all_columns_and_the_first_of_each_component(docs):
    rows = corpus()
    parts = slow_components(rows, [slow_fingerprint(t) for _, t in rows])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*{p for p in parts if p is not None}, None])  # the other row without id is a copy of an empty text


def test_keys_meet_for_every_pair_within_four_bits():
    r = np.random.default_rng(3)
    for _ in range(300):
        a = r.integers(0, 1 << 63, dtype=np.uint64)
        b = a
        for bit in r.choice(64, r.integers(1, 5), replace=False):
            b ^= np.uint64(1) << np.uint64(bit)
        rows, keys = simhash.bucket_keys(np.array([a, b], np.uint64))
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


def test_decoding_corrects_three_errors():
    words = np.arange(0, 1 << 23, 9973)
    table, errors = simhash._code()
    code = words ^ errors[table[0, words & 255] ^ table[1, words >> 8 & 255] ^ table[2, words >> 16 & 255]]
    assert (np.bitwise_count(words ^ code) <= 3).all()
    assert (simhash.decode(code) == simhash.decode(words)).all()


def test_near_links_each_component_to_its_first_member():
    r = np.random.default_rng(5)
    values = np.unique(np.concatenate([c ^ (np.uint64(1) << r.integers(0, 64, 40).astype(np.uint64)) for c in r.integers(0, 1 << 63, 4, dtype=np.uint64)]))
    links = simhash.near(values, 2)
    group = {a: frozenset([a, *(y for x, y in links if x == a)]) for a, _ in links}
    assert len(group) == 4 and sum(map(len, group.values())) == len(values) and all(a == min(g) for a, g in group.items())
    close = lambda x, y: (values[x] ^ values[y]).item().bit_count() <= 2
    assert all(any(close(x, y) for y in g if y != x) for g in group.values() for x in g)
    assert not any(close(x, y) for g in group.values() for x in g for y in set(range(len(values))) - g)


def test_oversized_buckets_give_the_same_components(spark, monkeypatch):
    r = np.random.default_rng(7)
    values = np.unique(np.concatenate([c ^ (np.uint64(1) << r.integers(0, 64, 30).astype(np.uint64)) for c in r.integers(0, 1 << 63, 3, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = simhash.midpoint_links(df, 4).collect()
    assert all(((x.a ^ x.b) & (2**64 - 1)).bit_count() <= 4 for x in links)
    owner = {int(v): int(v) for v in values.view(np.int64)}

    def root(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for x in links:
        owner[root(x.a)] = root(x.b)
    assert len({root(x) for x in owner}) == 3


def test_query_on_the_smallest_tables(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    fps = [slow_fingerprint(t) for _, t in rows]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op10_simhash(spark, d).collect()}
    assert got == {doc: (f"{f:016x}", c) for (doc, _), f, c in zip(rows, fps, slow_components(rows, fps))}
