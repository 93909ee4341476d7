"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere.

Suffixes are shipped sparsely.  Every string of ``length`` bytes is assigned to
an anchor, the smallest-hashed ``gram``-byte run within it (rightmost on ties),
so equal strings have equal anchors at equal offsets.  Consecutive strings with
one anchor make a piece: the suffixes of up to ``length - gram + 1`` starts in
less than twice ``length`` bytes.  Pieces whose anchor occurs only once are
dropped.  Sampled splitters range-partition the others by the leading bytes of
the anchored suffix; each bucket sorts all its suffixes by multikey quicksort,
eight bytes at a time, and neighbours that agree in ``length`` bytes are marked.
Equal strings share their anchor's bytes, so no equal pair crosses a bucket
boundary: a boundary falls between different leading bytes.

Texts are compared as whole UTF-8 byte strings.  Copies of a text are taken
together first: a text that occurs twice and has ``length`` bytes goes wholly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cograph.functions.skew import salted_join
from cograph.llm.common import scratch_table, shuffle_partitions, small_batches, texts_of
from cograph.llm.textnotes import BLOCK_BYTES, distinct_texts, texts_and_notes, with_texts

BASE = 0x9E3779B97F4A7C15
#: Pieces that share one anchor and are sorted in one task; more are counted by Spark instead.
BUCKET_PIECES = 16_384


@dataclass(frozen=True)
class Repeats:
    length: int = 200
    gram: int = 32


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` values, k a power of two: runs of doubling length are joined."""
    run, base, length = data.astype(np.uint64) + np.uint64(1), BASE, 1
    while length < k:
        run = run[:-length] * np.uint64(base) + run[length:]
        base, length = base * base % (1 << 64), 2 * length
    run ^= run >> np.uint64(29)
    run *= np.uint64(0xBF58476D1CE4E5B9)
    run ^= run >> np.uint64(32)
    return run


def pieces(data: np.ndarray, p: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, anchor, anchor hash) of a text's pieces, in order."""
    windows = len(data) - p.length + 1
    if windows < 1:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    hashes = gram_hashes(data, p.gram)
    n = len(hashes)
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)[::-1]
    width, reach = p.length - p.gram + 1, 1
    while 2 * reach <= width:
        ranked = np.minimum(ranked[:-reach], ranked[reach:])
        reach *= 2
    if reach < width:
        shift = width - reach
        ranked = np.minimum(ranked[:-shift], ranked[shift:])
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    anchor = n - 1 - (ranked[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return first, np.diff(np.concatenate((first, [windows]))), anchor, hashes[anchor]


def repeated(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Multikey quicksort of the suffixes at ``starts`` within ``groups``: mask
    of those that agree with another one of their group in ``length`` bytes.

    Each round sorts what is still tied by the next eight bytes, where a tie has
    different ones; a suffix that differs from all others leaves.
    """
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    word = np.zeros(len(data), np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | padded[i:i + len(data)]
    active = np.argsort(groups, kind="stable")
    tied = np.cumsum(np.diff(groups[active], prepend=groups[active[:1]]) != 0)
    active, tied = _still_tied(active, tied)
    depths = [*range(0, length - 7, 8)]
    if depths[-1] + 8 < length:
        depths.append(length - 8)
    for depth in depths:
        if not len(active):
            break
        w = word[starts[active] + depth]
        apart = np.flatnonzero((tied[1:] == tied[:-1]) & (w[1:] != w[:-1]))
        if not len(apart):
            continue
        mixed = np.zeros(int(tied[-1]) + 1, bool)
        mixed[tied[apart]] = True
        rows = np.flatnonzero(mixed[tied])  # ties are in order, so sorting them leaves each in its place
        order = rows[np.lexsort((w[rows], tied[rows]))]
        active[rows], w[rows] = active[order], w[order]
        fresh = np.zeros(len(active), bool)
        fresh[1:] = (tied[1:] != tied[:-1]) | (w[1:] != w[:-1])
        active, tied = _still_tied(active, np.cumsum(fresh))
    found = np.zeros(len(starts), bool)
    found[active] = True
    return found


def _still_tied(active: np.ndarray, tied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without those that are alone; ``tied`` numbers ties in order, from 0."""
    sizes = np.bincount(tied)
    kept = sizes[tied] > 1
    return active[kept], (np.cumsum(sizes > 1) - 1)[tied[kept]]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, text): two 64-bit hashes together name a text."""
    return texts_of(docs).select("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text")


def candidate_anchors(texts: DataFrame, p: Repeats) -> DataFrame:
    """(k1, k2, h): the anchors of each text that occur more than once over all distinct texts.

    An anchor found twice within a block is known to repeat, so of its rows only
    one per block is shuffled to the anchor's task; the others go on directly.
    """
    spark = texts.sparkSession
    schema = pa.schema([("key", pa.int64()), ("sure", pa.bool_()), ("several", pa.bool_()), ("h", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in distinct_texts(batches):
            found = [(k1, k2, *np.unique(pieces(np.frombuffer(text, np.uint8), p)[3], return_counts=True)) for k1, k2, text in block]
            h, n = (np.concatenate(x) for x in zip(*((h, n) for _, _, h, n in found)))
            h = h.view(np.int64)
            sizes = [len(x[2]) for x in found]
            k1, k2 = (np.repeat(np.array([x[i] for x in found], np.int64), sizes) for i in (0, 1))
            order = np.argsort(h, kind="stable")
            h, k1, k2, n = h[order], k1[order], k2[order], n[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = h[1:] != h[:-1]
            group = np.cumsum(fresh) - 1
            several = (np.bincount(group, n) > 1)[group]
            # one row of each anchor goes to the anchor, and all rows of a repeated one are sure already
            for rows, key, sure in ((fresh, h, False), (several, k1, True)):
                yield from pa.table([pa.array(key[rows]), pa.array(np.full(int(rows.sum()), sure)), pa.array(several[rows]),
                                     pa.array(h[rows]), pa.array(k1[rows]), pa.array(k2[rows])], schema=schema).to_batches(max_chunksize=65536)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by anchor: those that are sure, and those whose anchor has another text or several places."""
        names = ["k1", "k2", "h"]
        held = None  # first row of the anchor at hand
        for b in batches:
            sure, several, h, k1, k2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("sure", "several", "h", "k1", "k2"))
            out = [(k1[sure], k2[sure], h[sure])]
            rest = ~sure
            several, h, k1, k2 = several[rest], h[rest], k1[rest], k2[rest]
            if held is not None:
                several, h, k1, k2 = (np.concatenate(([x], y)) for x, y in zip(held, (several, h, k1, k2)))
            if len(h):
                begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                group = np.repeat(np.arange(len(begin)), np.diff(np.concatenate((begin, [len(h)]))))
                other = (k1 != k1[begin][group]) | (k2 != k2[begin][group]) | several
                known = np.bincount(group, other) > 0
                new = known[group] & ~several  # rows of several places are sure in their own block
                out.append((k1[new], k2[new], h[new]))
                last = begin[-1]  # once its anchor is known, the held row counts as reported
                held = several[last] or known[-1], h[last], k1[last], k2[last]
            k1, k2, h = (np.concatenate(x) for x in zip(*out))
            if len(h):
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array(h)], names=names)

    rows = texts.select("k1", "k2", "text").mapInArrow(emit, "key long, sure boolean, several boolean, h long, k1 long, k2 long")
    return rows.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("sure", "h").mapInArrow(resolve, "k1 long, k2 long, h long")


def repeated_starts(texts: DataFrame, p: Repeats) -> DataFrame:
    """(k1, k2, start, n): runs of starts in a text whose strings occur elsewhere in the distinct texts."""
    spark = texts.sparkSession
    schema = pa.schema([("lead", pa.binary()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("shift", pa.int64()), ("bytes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of the candidate anchors.  Of pieces with equal bytes within a
        block all starts are known to repeat: one goes on, all are reported."""
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = []
            for content, (lead, places) in held.items():
                rows.append((lead, *places[0], content))
                if len(places) > 1:
                    rows += [(x[0].to_bytes(8, "big", signed=True), *x, None) for x in places]  # a lead that spreads them
            for i in range(0, len(rows), 8192):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 8192]), schema)], schema=schema)

        for k1, k2, (anchors,), text in texts_and_notes(batches, ["h"]):
            start, n, anchor, h = pieces(np.frombuffer(text, np.uint8), p)
            for i in np.flatnonzero(np.isin(h.view(np.int64), anchors.astype(np.int64))).tolist():
                s, m, a = int(start[i]), int(n[i]), int(anchor[i])
                content = text[s:s + m + p.length - 1]
                entry = held.setdefault(content, (text[a:a + p.gram], []))
                size += 0 if entry[1] else len(content)
                entry[1].append((k1, k2, s, m, a - s))
            if size > BLOCK_BYTES // 2:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    def sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by lead.  Reports runs of repeated starts; pieces of an oversized lead go on as they are."""
        def resolve(t: pa.Table) -> Iterator[pa.RecordBatch]:
            content = t.column("bytes").combine_chunks()
            sizes = pc.binary_length(content).to_numpy().astype(np.int64)
            data = np.frombuffer(b"".join(content.to_pylist()), np.uint8)
            lead = t.column("lead").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
            n, start = t.column("n").to_numpy(), t.column("start").to_numpy()
            base = np.cumsum(sizes) - sizes
            piece = np.repeat(np.arange(len(n)), n)
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            # equal strings hold their anchor at equal offsets
            group = lead[piece] * p.length + t.column("shift").to_numpy()[piece] - place
            mask = repeated(data, base[piece] + place, group, p.length)
            gap = np.zeros(len(mask) + len(n), bool)  # a break after each piece
            gap[np.arange(len(mask)) + piece] = mask
            begin, end = runs(gap)
            owner = np.searchsorted(np.cumsum(n) + np.arange(len(n)), begin, "right")
            first = begin - owner - (np.cumsum(n) - n)[owner] + start[owner]
            k1, k2 = t.column("k1").to_numpy()[owner], t.column("k2").to_numpy()[owner]
            empty = pa.nulls(len(owner), pa.binary())
            yield from pa.table([empty, pa.array(k1), pa.array(k2), pa.array(first), pa.array(end - begin), pa.array(end - end), empty], schema=schema).to_batches()

        held: list[pa.RecordBatch] = []
        count, big = 0, None
        for b in (x.slice(i, 8192) for x in batches for i in range(0, x.num_rows, 8192)):
            known = b.column("bytes").is_null().to_numpy(zero_copy_only=False)
            if known.any():
                yield b.filter(pa.array(known))
                b = b.filter(pa.array(~known))
            if not b.num_rows:
                continue
            if big is not None:
                more = pc.equal(b.column("lead"), big)
                yield b.filter(more)
                b = b.filter(pc.invert(more))
                if not b.num_rows:
                    continue
                big = None
            held.append(b)
            count += b.num_rows
            if count < BUCKET_PIECES:
                continue
            t = pa.Table.from_batches(held)
            last = t.column("lead")[t.num_rows - 1]
            tail = t.filter(pc.equal(t.column("lead"), last))
            head = t.slice(0, t.num_rows - tail.num_rows)
            if head.num_rows:
                yield from resolve(head)
            if tail.num_rows >= BUCKET_PIECES:
                yield from tail.to_batches()
                big, held, count = last, [], 0
            else:
                held, count = tail.combine_chunks().to_batches(), tail.num_rows
        if held:
            yield from resolve(pa.Table.from_batches(held))

    small_batches(spark)
    spec = "lead binary, k1 long, k2 long, start long, n long, shift long, bytes binary"
    # written first: the splitters are sampled from it, which would cut all texts twice
    cut_pieces = scratch_table(with_texts(texts, candidate_anchors(texts, p), ["h"]).mapInArrow(cut, spec), "repeat-pieces")
    found = scratch_table(cut_pieces.repartitionByRange(shuffle_partitions(spark), "lead").sortWithinPartitions("lead").mapInArrow(sort_buckets, spec), "repeats")
    return found.filter("bytes is null").select("k1", "k2", "start", "n").union(
        oversized_starts(found.filter("bytes is not null").select("k1", "k2", "start", "n", "bytes"), p))


def oversized_starts(found: DataFrame, p: Repeats) -> DataFrame:
    """The same for pieces of anchors that too many different pieces share: every
    string is named by a 128-bit hash and counted with partial aggregates."""
    import xxhash

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k1, k2, start, n, content in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "start", "n", "bytes"))):
                names = [xxhash.xxh3_128_digest(content[i:i + p.length]) for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(np.full(n, k1)), pa.array(np.full(n, k2)), pa.array(np.arange(start, start + n))],
                                                 names=["name", "k1", "k2", "start"])

    rows = found.mapInArrow(strings, "name binary, k1 long, k2 long, start long")
    again = rows.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name")
    return salted_join(rows, again, "name", hint="merge").select("k1", "k2", "start", F.lit(1).cast("long").alias("n"))


def remove_repeats(docs: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``.

    Removed is each byte covered by a string of ``length`` bytes that also
    starts anywhere else in the documents, the same one included.  Null texts
    are empty; texts under ``length`` bytes lose nothing; repeated rows are
    copies like any other; a null doc_id keeps its row.
    """
    if p.gram & (p.gram - 1) or not 8 <= p.gram <= p.length:
        raise ValueError("gram is a power of two from 8 to length")
    texts = keyed(docs)
    long = texts.filter(F.octet_length("text") >= p.length)
    starts = repeated_starts(long, p)
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for k1, k2, (first, n), text in texts_and_notes(batches, ["start", "n"]):
            step = np.zeros(len(text) + 1, np.int64)
            np.add.at(step, first.astype(np.int64), 1)
            np.add.at(step, (first + n + p.length - 1).astype(np.int64), -1)
            gone = np.cumsum(step[:-1]) > 0
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            held.append((k1, k2, int(gone.sum()), len(runs(gone)[0]), hashlib.sha256(kept).hexdigest()))
            if len(held) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    changed = with_texts(long, starts, ["start", "n"]).mapInArrow(remove, "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string")
    rows = texts.select("doc_id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own_sha256"))
    copies = rows.filter(F.col("n_bytes") >= p.length).groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    known = copies.join(changed, ["k1", "k2"], "left").filter("copies > 1 or n_removed is not null")
    whole = F.coalesce(F.col("copies") > 1, F.lit(False))
    return salted_join(rows, known, ["k1", "k2"], "left", hint="merge").select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "own_sha256")).alias("kept_sha256"))
