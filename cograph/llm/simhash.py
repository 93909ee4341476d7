"""SimHash near-dedup: Golay-code fuzzy hashing of 64-bit fingerprints.

A fingerprint is cut into three segments of 22, 21 and 21 bits.  Four
differing bits leave two segments with at most two errors in all: either at
most one in each, or none in one and two in the other.  The perfect binary
Golay code (23, 12) decodes a segment and each of its one-bit neighbours to
the nearest codeword; two segments that differ in at most two bits share a
neighbour and so a codeword, and two that differ in at most one bit find the
codeword of one among those of the other.  Joint keys over two segments bring
every pair within four bits into a common bucket, where distances are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cograph.functions.skew import salted_join
from cograph.llm.common import scratch_table, shuffle_partitions, small_batches, texts_of
from cograph.llm.components import connected_components

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
#: Buckets above this many fingerprints are resolved by common midpoints instead.
BUCKET = 1 << 15
GENERATOR = 0xAE3  # x^11+x^9+x^7+x^6+x^5+x+1, a generator of the (23, 12) Golay code


def fingerprint(text: bytes, words_per_shingle: int = 4) -> int:
    """64-bit SimHash of a text: ASCII lower case, words between ASCII white
    space, shingles with repeats; zero if there is no word."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= words_per_shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: n - words_per_shingle + 1].tolist()
    stops = (ends[words_per_shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), 1 << 16):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i:i + (1 << 16)], stops[i:i + (1 << 16)])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """(doc_id, k1, k2, fp): one row per row of ``docs``; fp holds the 64 bits in
    a signed long, k1 and k2 are two 64-bit hashes of the text."""
    names = ["doc_id", "k1", "k2"]
    schema = pa.schema([(c, pa.int64()) for c in [*names, "fp"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes(), words_per_shingle) for t in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(fps.view(np.int64))], schema=schema)

    small_batches(docs.sparkSession)
    return texts_of(docs).select("doc_id", *_text_keys("text"), "text").mapInArrow(run, "doc_id long, k1 long, k2 long, fp long")


def _text_keys(text: str) -> tuple:
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")


@lru_cache(None)
def _code() -> tuple[np.ndarray, np.ndarray]:
    """(syndromes of each byte value at each of three byte positions, error pattern of each syndrome)."""
    def rest(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    unit = [rest(1 << i) for i in range(23)]
    table = np.zeros((3, 256), np.int64)
    for place in range(3):
        for value in range(256):
            for i in range(8):
                if value >> i & 1 and 8 * place + i < 23:
                    table[place, value] ^= unit[8 * place + i]
    errors = np.zeros(2048, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            s = 0
            for i in bits:
                s ^= unit[i]
            errors[s] = sum(1 << i for i in bits)
    return table, errors


def decode(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    table, errors = _code()
    s = table[0, words & 255] ^ table[1, words >> 8 & 255] ^ table[2, words >> 16 & 255]
    return (words ^ errors[s]) >> 11


def segment_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of each word (first column) and of its one-bit
    neighbours, and a mask that keeps each index of a row once."""
    flips = np.concatenate(([0], 1 << np.arange(bits)))
    keys = decode(words[:, None] ^ flips[None, :])
    order = np.argsort(keys, axis=1, kind="stable")
    ranked = np.take_along_axis(keys, order, axis=1)
    fresh = np.ones_like(ranked, bool)
    fresh[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    mask = np.zeros_like(fresh)
    np.put_along_axis(mask, order, fresh, axis=1)
    return keys, mask


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, keys): the bucket keys of each fingerprint."""
    words = [((fps >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64) for first, bits in SEGMENTS]
    found = [segment_keys(w, bits) for w, (_, bits) in zip(words, SEGMENTS)]
    rows, keys = [], []
    for pair, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        (ka, ma), (kb, mb) = found[a], found[b]
        for kind, (left, right, mask) in enumerate((
                (ka[:, :1], kb, mb), (ka, kb[:, :1], ma),  # at most one error in each
                (words[a][:, None], kb, mb), (ka, words[b][:, None], ma))):  # none in one, two in the other
            left, right = np.broadcast_arrays(left, right)
            r, c = np.nonzero(mask)
            rows.append(r)
            keys.append((pair * 3 + max(0, kind - 1)) << 48 | left[r, c] << 24 | right[r, c])
    return np.concatenate(rows), np.concatenate(keys)


def near(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links (first, member) from the first value of each component over
    distances of up to ``bits`` to its other members: at most len(values) - 1."""
    left = np.arange(len(values))
    links = []
    while len(left):
        first, left = int(left[0]), left[1:]
        front = [first]
        while front and len(left):
            hit = np.bitwise_count(values[left] ^ values[front.pop()]) <= bits
            members = left[hit].tolist()
            links += [(first, y) for y in members]
            front += members
            left = left[~hit]
    return links


def bucket_links(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[list, list, list]:
    """Links (a, b) within the buckets of rows sorted by key, and the fingerprints of oversized buckets."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    a, b, hot = [], [], []
    small = np.repeat(np.where(sizes <= 8, sizes, 0), sizes)
    place = np.arange(len(keys)) - np.repeat(starts, sizes)
    for shift in range(1, 8):
        i = np.flatnonzero(place + shift < small)
        j = i + shift
        ok = (np.bitwise_count(fps[i] ^ fps[j]) <= bits) & (fps[i] != fps[j])
        a.append(fps[i[ok]])
        b.append(fps[j[ok]])
    for s, n in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist()):
        members = np.unique(fps[s:s + n])
        if len(members) > BUCKET:
            hot.append(members)
        elif links := near(members, bits):
            x, y = np.array(links).T
            a.append(members[x])
            b.append(members[y])
    return a, b, hot


def fingerprint_links(distinct: DataFrame, bits: int = 4) -> DataFrame:
    """Links (a, b) between different fingerprints ``fp`` that are connected over
    distances of at most ``bits`` <= 4: enough of them that components over the
    links are exact.  Within a bucket they join at its components' first members."""
    if not 0 <= bits <= 4:
        raise ValueError("the keys cover distances up to 4")
    spark = distinct.sparkSession

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
        for b in batches:
            for i in range(0, b.num_rows, 8192):
                fps = b.column("fp").slice(i, 8192).to_numpy(zero_copy_only=False)
                rows, keys = bucket_keys(fps.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], schema=schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hot", pa.bool_())])

        def resolve(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b, hot = bucket_links(keys, fps, bits)
            a, b, hot = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (a, b, hot))
            ends = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((ends[:, 0], hot)).view(np.int64)), pa.array(np.concatenate((ends[:, 1], hot)).view(np.int64)),
                pa.array(np.arange(len(ends) + len(hot)) >= len(ends))], schema=schema)

        def oversized(fps: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64))] * 2 + [pa.array(np.ones(len(fps), bool))], schema=schema)

        k, f, open_key = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            k = np.concatenate((k, batch.column("key").to_numpy()))
            f = np.concatenate((f, batch.column("fp").to_numpy().view(np.uint64)))
            if open_key is not None:  # the rest of a bucket too large to hold
                n = int(np.searchsorted(k, open_key, "right"))
                if n:
                    yield oversized(f[:n])
                k, f = k[n:], f[n:]
            if not len(k):
                continue
            last = int(np.searchsorted(k, k[-1]))
            if last:
                yield from resolve(k[:last], f[:last])
                k, f = k[last:], f[last:]
            if len(k) > 2 * BUCKET:
                yield oversized(f)
                open_key = k[-1]
                k, f = k[:0], f[:0]
        if len(k):
            yield from resolve(k, f)

    keys = distinct.select("fp").mapInArrow(emit, "key long, fp long")
    found = scratch_table(
        keys.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", "fp")
        .mapInArrow(compare, "a long, b long, hot boolean").distinct(), "simhash-links")
    return found.filter("not hot").select("a", "b").union(midpoint_links(found.filter("hot").select(F.col("a").alias("fp")).distinct(), bits))


def midpoint_links(distinct: DataFrame, bits: int = 4) -> DataFrame:
    """Links between fingerprints of oversized buckets: each is a key for every
    value within bits/2 of it, and all members of a key are linked to its
    smallest one.  Members of a key are within ``bits`` of each other, and each
    pair within ``bits`` shares a key."""
    masks = np.array([sum(1 << i for i in c) for w in range((bits + 1) // 2 + 1) for c in combinations(range(64), w)], np.uint64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("mid", pa.int64()), ("fp", pa.int64())])
        for b in batches:
            for fp in b.column("fp").to_numpy(zero_copy_only=False):
                mids = masks ^ np.array([fp]).view(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(mids.view(np.int64)), pa.array(np.full(len(mids), fp))], schema=schema)

    mids = distinct.mapInArrow(spread, "mid long, fp long")
    least = mids.groupBy("mid").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).filter("a < top").drop("top")
    return salted_join(mids, least, "mid").filter((F.col("a") != F.col("fp")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= bits)) \
        .select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words_per_shingle: int = 4, bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``.

    Documents link where their fingerprints differ in at most ``bits`` bits;
    component_id is the smallest doc_id reachable.  Null and empty texts have
    fingerprint 0 and are linked like any other.  Repeated rows repeat in the
    result.  A null doc_id keeps its row and is never a component_id, except
    where a component has no other id (then component_id is null).
    """
    fps = scratch_table(fingerprints(docs, words_per_shingle).select("doc_id", "fp"), "simhash")
    distinct = scratch_table(fps.groupBy("fp").agg(F.min("doc_id").alias("doc")), "simhash-distinct")
    parts = connected_components(fingerprint_links(distinct, bits)).select(F.col("node").alias("fp"), "component")
    members = distinct.join(parts, "fp", "left").select("fp", "doc", F.coalesce("component", "fp").alias("component"))
    least = members.groupBy("component").agg(F.min("doc").alias("component_id"))
    members = salted_join(members.select("fp", "component"), least, "component", hint="merge").select("fp", "component_id")
    return salted_join(fps, members, "fp", hint="merge").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words_per_shingle: int = 4, bits: int = 4) -> DataFrame:
    """One document of each component of ``docs``, all columns: the one with the
    smallest doc_id, a null id counting as larger than any other.  Of documents
    that share this id, or of several without one, the text with the smallest
    hashes stays; of rows with one id and text the one with the smallest hash of
    all columns.  Documents of different components are never taken for one
    another, whatever their ids."""
    fps = scratch_table(fingerprints(docs, words_per_shingle), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k1", "k2"))
    distinct = scratch_table(fps.groupBy("fp").agg(first.alias("first")), "simhash-distinct")
    parts = connected_components(fingerprint_links(distinct, bits)).select(F.col("node").alias("fp"), "component")
    winners = scratch_table(distinct.join(parts, "fp", "left").groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias("first"))
                            .select(*(F.col(f"first.{c}").alias(f"_{c}") for c in ("doc_id", "k1", "k2"))), "simhash-kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").cast("long").alias("_id"), text.alias("_text")) \
        .select("_row", "_id", F.xxhash64("_text").alias("_a"), F.xxhash64(F.lit(1), "_text").alias("_b"))
    kept = keyed.join(winners, (F.col("_a") == F.col("_k1")) & (F.col("_b") == F.col("_k2")) & F.col("_id").eqNullSafe(F.col("_doc_id")), "left_semi")
    return kept.groupBy("_id", "_a", "_b").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row.*")
