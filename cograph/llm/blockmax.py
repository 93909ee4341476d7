"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

A shard is a run of whole documents that one task reads.  Its posting lists,
for the terms that are asked for, are cut into blocks of compressed document
numbers and frequencies; beside a block stand its first and last document, its
highest frequency and its shortest document, which bound every score in it.

For a query the lists are ordered by their highest bound.  As many of the
lowest as together stay under the k-th best score so far are non-essential: no
document that only they hold can enter.  The others are traversed.  For the
documents found there, a non-essential list's block bounds come first: where
even the bound can't lift a document to the k-th score, its block stays
compressed.  A task carries its best k per query from shard to shard, and a
window merges the tasks' results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cograph.llm.common import blocks, scratch_table, small_batches, texts_of

SHARD_BYTES = 64 << 20  # text of a shard
POSTINGS = 128  # of a block
SPAN = 4096  # documents between two updates of the threshold
QUERY_TERMS = 1 << 20  # (query, term) pairs that are asked at once
CHUNK = 4 << 20
WIDTHS = [np.dtype("u1"), np.dtype("<u2"), np.dtype("<u4")]

# letters, digits and every byte of a non-ASCII character make up terms; only A-Z change case
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

INDEX_SCHEMA = pa.schema([
    ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("firsts", pa.binary()), ("lasts", pa.binary()),
    ("most", pa.binary()), ("least", pa.binary()), ("ends", pa.binary()), ("data", pa.binary())])
INDEX_TYPES = "n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, terms array<int>, counts array<long>, " \
              "firsts binary, lasts binary, most binary, least binary, ends binary, data binary"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of bounded size."""
    at = 0
    while at < len(text):
        part = text[at:at + CHUNK].translate(_TERM_BYTES)
        if at + CHUNK < len(text):
            cut = part.rfind(b" ")
            if cut < 0:  # a term of more than a chunk: look for its end
                end = at + CHUNK
                while end < len(text) and text[end:end + 1].translate(_TERM_BYTES) != b" ":
                    end += 1
                part, cut = text[at:end].translate(_TERM_BYTES), end - at
            part = part[:cut]
            at += max(cut, 1)
        else:
            at = len(text)
        yield part.split()


def _narrowest(values: np.ndarray) -> np.dtype:
    top = int(values.max(initial=0))
    return WIDTHS[0] if top < 1 << 8 else WIDTHS[1] if top < 1 << 16 else WIDTHS[2]


def compress(docs: np.ndarray, counts: np.ndarray) -> bytes:
    """A block: widths, gaps between documents, frequencies."""
    gaps = np.diff(docs)
    a, b = _narrowest(gaps), _narrowest(counts)
    return bytes((a.itemsize << 4 | b.itemsize,)) + gaps.astype(a).tobytes() + counts.astype(b).tobytes()


def decompress(data: bytes, first: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = (WIDTHS[w >> 1] for w in (data[0] >> 4, data[0] & 15))
    n = (len(data) - 1 + a.itemsize) // (a.itemsize + b.itemsize)
    docs = np.empty(n, np.int64)
    docs[0] = first
    docs[1:] = np.frombuffer(data, a, n - 1, 1)
    return np.cumsum(docs), np.frombuffer(data, b, n, 1 + (n - 1) * a.itemsize).astype(np.int64)


def shard_row(texts: pa.Table, number: dict[bytes, int]) -> dict:
    """Index of whole texts for the terms in ``number``."""
    found, lengths = [], np.zeros(texts.num_rows, np.int64)
    for i, text in enumerate(texts.column("text")):
        for terms in terms_of(text.as_buffer().to_pybytes()):
            lengths[i] += len(terms)
            known = np.fromiter(map(number.get, terms, repeat(-1)), np.int64, len(terms))
            known = known[known >= 0]
            if len(known):
                found.append(known << 32 | i)
    keys, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    term, doc = keys >> 32, keys & 0xFFFFFFFF
    new = np.flatnonzero(np.diff(term, prepend=-1))
    size = np.diff(np.append(new, len(term)))
    begins = np.concatenate([np.arange(a, a + n, POSTINGS) for a, n in zip(new.tolist(), size.tolist())]) if len(new) else np.zeros(0, np.int64)
    ends = np.append(begins[1:], len(term))[:len(begins)]
    data = [compress(doc[a:b], counts[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
    reduce = lambda f, x: f.reduceat(x, begins) if len(begins) else np.zeros(0, np.int64)
    return {"n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()),
            "doc_ids": texts.column("doc_id").combine_chunks(), "lengths": lengths, "terms": term[new].astype(np.int32), "counts": size,
            "firsts": doc[begins].astype("<i4").tobytes(), "lasts": doc[ends - 1].astype("<i4").tobytes(),
            "most": reduce(np.maximum, counts).astype("<i8").tobytes(), "least": reduce(np.minimum, lengths[doc]).astype("<i8").tobytes(),
            "ends": np.cumsum(np.fromiter(map(len, data), np.int64, len(data))).astype("<i8").tobytes(), "data": b"".join(data)}


def _one(value, kind: pa.DataType) -> pa.Array:
    """A column of one row."""
    if not pa.types.is_list(kind):
        return pa.array([value], kind)
    return pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value if isinstance(value, pa.Array) else pa.array(value, kind.value_type))


def index(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """One row per shard: the posting blocks of the terms in ``number``."""
    wanted = docs.sparkSession.sparkContext.broadcast(number)  # at most QUERY_TERMS terms, see search

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SHARD_BYTES):
            row = shard_row(block, wanted.value)
            yield pa.RecordBatch.from_arrays([_one(row[f.name], f.type) for f in INDEX_SCHEMA], schema=INDEX_SCHEMA)

    small_batches(docs.sparkSession)
    return texts_of(docs).mapInArrow(run, INDEX_TYPES)


def impact(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * count // (1000 * count + 12 * m)


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Best:
    """The k best documents of a query so far: score descending, then id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A document has to reach this score; with an equal one its id decides."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids)), np.concatenate((self.nulls, nulls))
        at = np.lexsort((ids, nulls, -scores))[:self.k]
        self.scores, self.ids, self.nulls = scores[at], ids[at], nulls[at]


class Shard:
    def __init__(self, row: dict, n: int, total: int):
        """``n`` documents with terms and ``total`` terms in the whole corpus."""
        ids = row["doc_ids"]
        self.nulls = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.m = self._norms(np.asarray(row["lengths"]), n, total)
        read = lambda c, t: np.frombuffer(row[c], t).astype(np.int64)
        self.firsts, self.lasts, self.ends, self.data = read("firsts", "<i4"), read("lasts", "<i4"), read("ends", "<i8"), row["data"]
        self.bounds = impact(read("most", "<i8"), self._norms(read("least", "<i8"), n, total))
        blocks_of = -(-np.asarray(row["counts"], np.int64) // POSTINGS)
        stop = np.cumsum(blocks_of)
        self.lists = {t: (a, b) for t, a, b in zip(np.asarray(row["terms"]).tolist(), (stop - blocks_of).tolist(), stop.tolist())}
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @staticmethod
    def _norms(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
        small, at = np.unique(lengths, return_inverse=True)
        return np.array([75 + 25 * x * n // max(total, 1) for x in small.tolist()], np.int64)[at]  # whole numbers of any size

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of a block, decompressed when it is first needed."""
        if b not in self.open:
            docs, counts = decompress(self.data[self.ends[b - 1] if b else 0:self.ends[b]], int(self.firsts[b]))
            self.open[b] = docs, impact(counts, self.m[docs])
        return self.open[b]

    def search(self, query: list[tuple[int, int]], best: Best) -> None:
        """Adds to ``best`` what this shard has for (term, factor) pairs."""
        lists = [(self.lists[t], factor) for t, factor in query if factor and t in self.lists]
        tops = [factor * int(self.bounds[a:b].max()) for (a, b), factor in lists]
        order = sorted(range(len(lists)), key=tops.__getitem__)
        lists, tops = [lists[i] for i in order], [tops[i] for i in order]
        below = np.concatenate(([0], np.cumsum(np.array(tops, np.int64))))  # most that the first lists can add
        n = len(self.m)
        for begin in range(0, n, SPAN):
            stop = min(begin + SPAN, n)
            least = best.least
            if below[-1] < least:
                return
            first = int(np.searchsorted(below, least)) - 1  # lists before it are non-essential
            score = np.zeros(stop - begin, np.int64)
            for (a, b), factor in lists[first:]:
                lo, hi = a + np.searchsorted(self.lasts[a:b], begin), a + np.searchsorted(self.firsts[a:b], stop)
                for x in range(int(lo), int(hi)):
                    docs, gain = self.block(x)
                    if docs[0] < begin or docs[-1] >= stop:
                        inside = slice(*np.searchsorted(docs, (begin, stop)))
                        docs, gain = docs[inside], gain[inside]
                    score[docs - begin] += factor * gain
            at = np.flatnonzero(score)
            score = score[at]
            at += begin
            for i in range(first - 1, -1, -1):
                alive = score + below[i + 1] >= least
                at, score = at[alive], score[alive]
                if not len(at):
                    break
                (a, b), factor = lists[i]
                own = a + np.searchsorted(self.lasts[a:b], at)
                held = own < b
                held[held] &= self.firsts[own[held]] <= at[held]
                bound = np.zeros(len(at), np.int64)
                bound[held] = factor * self.bounds[own[held]]
                alive = score + bound + below[i] >= least  # else rejected with the block still compressed
                at, score, own, held = at[alive], score[alive], own[alive], held[alive]
                for x in np.unique(own[held]).tolist():
                    docs, gain = self.block(x)
                    mine = np.flatnonzero(held & (own == x))
                    place = np.minimum(np.searchsorted(docs, at[mine]), len(docs) - 1)
                    hit = docs[place] == at[mine]
                    score[mine[hit]] += factor * gain[place[hit]]
            alive = score >= least
            at, score = at[alive], score[alive]
            if len(at):
                best.add(score, self.ids[at], self.nulls[at])


def _asked(items: DataFrame) -> DataFrame:
    """(item_id, term, n): how often each item asks for each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("doc_id"), batch.column("text")):
                for terms in terms_of(text.as_buffer().to_pybytes()):
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(terms), pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"])

    return texts_of(items, "item_id").mapInArrow(run, "item_id long, term binary").groupBy("item_id", "term").agg(F.count("*").alias("n"))


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item (item_id, text) the ``k``
    documents (doc_id, text) of the highest score above 0.

    Terms are runs of ASCII letters and digits and all non-ASCII characters,
    with A-Z lower-cased; null texts have none.  Equal scores rank by ascending
    doc_id, a null doc_id last.  Every row of ``docs`` is a document of its own,
    also when its id repeats; rows of ``items`` with one item_id, or with none,
    are one item.  Items without terms, or whose terms nobody has, give no rows,
    nor do empty tables.  Document counts and frequencies are those of all of
    ``docs``.  Items are asked in blocks of about QUERY_TERMS (item, term)
    pairs; an item is never split.
    """
    asked = scratch_table(_asked(items), "search-items")
    parts = max(1, -(-asked.count() // QUERY_TERMS))
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    found = [_search_block(docs, asked.filter(part == i), k) for i in range(parts)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _search_block(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    pairs = asked.collect()  # bounded by QUERY_TERMS
    number = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in pairs}))}
    shards = scratch_table(index(docs, number), "search-index")
    n, total = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy(F.col("x.terms").alias("t")).agg(F.sum("x.counts").alias("df"))
    weight = {r.t: term_weight(n, r.df) for r in df.collect()}  # at most as many as in number
    queries: dict[int | None, list[tuple[int, int]]] = {}
    for r in pairs:
        t = number[bytes(r.term)]
        queries.setdefault(r.item_id, []).append((t, r.n * weight.get(t, 0)))
    told = spark.sparkContext.broadcast((sorted(queries.items(), key=str), n or 0, total or 0))
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, n, total = told.value
        best = [Best(k) for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("doc_ids", "lengths", "terms", "counts")}
                row = {c: x.values if c == "doc_ids" else x.values.to_numpy(zero_copy_only=False) for c, x in row.items()}
                row |= {c: batch.column(c)[i].as_buffer().to_pybytes() for c in ("firsts", "lasts", "most", "least", "ends", "data")}
                shard = Shard(row, n, total)
                for (_, query), b in zip(asked, best):
                    shard.search(query, b)
        for (item, _), b in zip(asked, best):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(b.ids), pa.int64()), pa.array(b.ids, mask=b.nulls), pa.array(b.scores)], schema=schema)

    found = shards.mapInArrow(run, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
