"""Lexical retrieval packing: documents that share rare terms fill a window together.

Documents are tokenised and ordered by a min-hash of their heaviest BM25 terms
that other documents have too, so that lexical neighbours lie together; runs of
a bounded number of tokens in that order are the shards.  A shard holds a BM25 inverted index of its documents, weighted with document
frequencies and the mean length of the whole corpus; terms are token ids, so
the frequency table is bounded by the vocabulary.  A seed document asks the
index for unused neighbours, which fill its window in the order of their
scores; the document that overflows a window is cut there, and its rest seeds
the next one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cograph.llm.common import blocks, scratch_table, small_batches, texts_of
from cograph.llm.wordblocks import WordEncoder

BLOCK_BYTES = 16 << 20


@dataclass(frozen=True)
class Packing:
    window: int = 2048
    end_id: int = 1
    shard_tokens: int = 4_000_000
    query_terms: int = 16
    k1: float = 1.2
    b: float = 0.75


@lru_cache(None)
def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def tokenizer_words(tokenizer_json: str):
    """``encode_words`` of a byte-level BPE tokenizer file, for `WordEncoder`."""
    from tokenizers import Tokenizer

    spec = json.loads(tokenizer_json)
    before = spec.get("pre_tokenizer") or {}
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError("a byte-level tokenizer without normalizer or prefix space is needed")
    tokenize = Tokenizer.from_str(tokenizer_json).model.tokenize
    chars = byte_chars()

    def encode_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [[t.id for t in tokenize(w.encode().decode("latin-1").translate(chars))] for w in words]
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(ends[-1])), ends

    return encode_words


def tokenized(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """(doc_id, n long, ids binary): compressed token ids with ``end_id`` after
    each document; and, with n = -1, rows of (ids, documents) that hold the
    document frequencies of one task's rows."""
    with open(tokenizer_file) as f:
        text = f.read()
    spec = docs.sparkSession.sparkContext.broadcast(text)  # one vocabulary file, under 2 MB
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_words(spec.value))
        pack = zstandard.ZstdCompressor(level=1).compress
        df = np.zeros(1 << 16, np.int64)
        for block in blocks(batches, "text", BLOCK_BYTES):
            held, n = [], []
            for ids in encoder.encode(block.column("text").to_pylist()):
                ids = np.append(ids, np.uint32(end_id))
                terms = np.unique(ids)
                if int(terms[-1]) >= len(df):
                    df = np.concatenate((df, np.zeros(int(terms[-1]) + 1, np.int64)))
                df[terms] += 1
                n.append(len(ids))
                held.append(pack(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()))
            yield from pa.table([block.column("doc_id"), pa.array(n, pa.int64()), pa.array(held, pa.binary())], schema=schema).to_batches(max_chunksize=512)
        seen = np.flatnonzero(df)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([-1], pa.int64()),
                                              pa.array([np.stack((seen, df[seen])).astype("<i8").tobytes()], pa.binary())], schema=schema)

    small_batches(docs.sparkSession)
    return texts_of(docs).mapInArrow(run, "doc_id long, n long, ids binary")


def token_ids(packed: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def document_frequencies(tokens: DataFrame) -> np.ndarray:
    """Documents that hold each token id, over the whole corpus: one number for each id of the vocabulary."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column("ids").to_pylist():
                ids, df = np.frombuffer(x, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(df)], names=["id", "df"])

    rows = tokens.filter("n < 0").select("ids").mapInArrow(pairs, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).collect()
    found = np.zeros(max([0, *(r["id"] for r in rows)]) + 1, np.int64)
    for r in rows:
        found[r["id"]] = r["df"]
    return found


def term_weights(ids: np.ndarray, idf: np.ndarray, mean: float, p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of a document and their BM25 weights."""
    t, tf = np.unique(ids, return_counts=True)
    return t, idf[t] * tf * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * len(ids) / mean))


def lexical_key(ids: np.ndarray, idf: np.ndarray, df: np.ndarray, mean: float, p: Packing) -> tuple[int, int]:
    """The two smallest hashes among the ``query_terms`` heaviest terms of a
    document that another document has too: texts that share most of them
    mostly share these."""
    t, w = term_weights(ids, idf, mean, p)
    shared = df[t] > 1
    t, w = t[shared], w[shared]
    if len(t) > p.query_terms:
        t = t[np.lexsort((t, -w))[:p.query_terms]]
    h = t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = np.sort((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(2)).astype(np.int64)
    return tuple([*h[:2].tolist(), -1, -1][:2])


def _idf(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log1p((n_docs - df + 0.5) / (df + 0.5))


def keyed_tokens(tokens: DataFrame, df: np.ndarray, n_docs: int, mean: float, p: Packing) -> DataFrame:
    """(doc_id, n, ids, key, key2): the documents of `tokenized` with their lexical key."""
    held = tokens.sparkSession.sparkContext.broadcast(df)  # one number for each id of the vocabulary
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("key", pa.int64()), ("key2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = _idf(held.value, n_docs)
        for b in batches:
            keys = [lexical_key(token_ids(x), idf, held.value, mean, p) for x in b.column("ids").to_pylist()]
            if keys:
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "n", "ids")), *(pa.array(k, pa.int64()) for k in zip(*keys))], schema=schema)

    return tokens.filter("n >= 0").mapInArrow(run, "doc_id long, n long, ids binary, key long, key2 long")


class Shard:
    """BM25 index of one shard's documents; a seed asks with all its terms.

    A term that many of the documents hold has its weights as a row with one
    number for each document, which is added as a whole; the others have
    posting lists.  Weights are rounded to 24 bits, so that sums do not depend
    on their order."""

    DENSE = 10  # a row takes less time than a list of over one document in so many

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float, p: Packing):
        self.n = len(ids)
        terms, docs, weights, self.queries = [], [], [], []
        for d, x in enumerate(ids):
            t, w = term_weights(x, idf, mean, p)
            terms.append(t)
            docs.append(np.full(len(t), d, np.int64))
            weights.append(w.astype(np.float32).astype(float))
            self.queries.append(t)
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        self.unused = np.ones(self.n, bool)
        self.left = self.n
        self._hold(np.arange(self.n), term[order], np.concatenate(docs)[order], np.concatenate(weights)[order])

    def _hold(self, numbers: np.ndarray, term: np.ndarray, docs: np.ndarray, weights: np.ndarray) -> None:
        """Index of the documents ``numbers``; postings, in the order of their terms, have places in it."""
        self.numbers, self.held = numbers, len(numbers)
        counts = np.bincount(term, minlength=1)
        often = counts * self.DENSE > self.held
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.rows = np.zeros((int(often.sum()), self.held))
        dense = often[term]
        self.rows[self.row[term[dense]], docs[dense]] = weights[dense]
        self.term, self.docs, self.weights = term[~dense], docs[~dense], weights[~dense]
        self.starts = np.concatenate(([0], np.cumsum(np.where(often, 0, counts))))

    def take(self, doc: int) -> None:
        """Marks ``doc`` as used; when half of the documents held are used, those go."""
        self.unused[doc] = False
        self.left -= 1
        if 2 * self.left < self.held:
            stays = self.unused[self.numbers]
            place = np.cumsum(stays) - 1
            kept = stays[self.docs]
            often = np.flatnonzero(self.row >= 0)
            rows = self.rows[:, stays]
            r, d = np.nonzero(rows)
            term = np.concatenate((self.term[kept], often[r]))
            order = np.argsort(term, kind="stable")
            self._hold(self.numbers[stays], term[order], np.concatenate((place[self.docs[kept]], d))[order],
                       np.concatenate((self.weights[kept], rows[r, d]))[order])

    def neighbours(self, doc: int) -> Iterator[int]:
        """Unused documents that share a term with ``doc``, best first, ties to the smaller number."""
        asked = self.queries[doc]
        asked = asked[:np.searchsorted(asked, len(self.row))]  # the highest terms may be gone
        begin, end = self.starts[asked], self.starts[asked + 1]
        spans = [slice(a, b) for a, b in zip(begin[begin < end].tolist(), end[begin < end].tolist())]
        numbers, n = self.numbers, self.held
        scores = np.bincount(np.concatenate([self.docs[s] for s in spans]), np.concatenate([self.weights[s] for s in spans]), minlength=n) \
            if spans else np.zeros(n)
        for r in self.row[asked].tolist():
            if r >= 0:
                scores += self.rows[r]
        scores[~self.unused[numbers]] = 0
        best, done = 8, np.inf
        while True:
            low = -np.partition(-scores, best - 1)[best - 1] if best < n else 0
            found = np.flatnonzero((scores < done) & (scores >= low) & (scores > 0))  # with all ties of the last
            for d in numbers[found[np.lexsort((found, -scores[found]))]].tolist():
                if self.unused[d]:
                    yield d
            if low <= 0:
                return
            best, done = best * 8, low


def fill(sizes: list[int], shard: Shard, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset).  Every sequence is
    full but for the shard's last, which is cut into powers of two."""
    pieces: list[tuple[int, int, int, int, int]] = []
    room, sequence, next_seed = window, 0, 0
    doc, neighbours = None, iter(())
    for _ in range(len(sizes)):
        d = next((x for x in neighbours), None)
        if d is None and doc is not None:
            neighbours = shard.neighbours(doc)
            d = next(neighbours, None)
        if d is None:
            while not shard.unused[next_seed]:
                next_seed += 1
            d = doc = next_seed
            neighbours = iter(())
        shard.take(d)
        start = 0
        while start < sizes[d]:
            length = min(room, sizes[d] - start)
            pieces.append((d, start, length, sequence, window - room))
            start, room = start + length, room - length
            if not room:
                room, sequence = window, sequence + 1
                doc, neighbours = d, iter(())
    return _cut_tail(pieces, sequence, window - room)


def _cut_tail(pieces: list, sequence: int, size: int) -> list:
    tail = [p for p in pieces if p[3] == sequence]
    out = pieces[:len(pieces) - len(tail)]
    bounds = [0]
    for bit in range(size.bit_length() - 1, -1, -1):
        if size >> bit & 1:
            bounds.append(bounds[-1] + (1 << bit))
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        for d, start, length, _, offset in tail:
            a, b = max(low, offset), min(high, offset + length)
            if a < b:
                out.append((d, start + a - offset, b - a, sequence + i, a - low))
    return out


def pack(docs: DataFrame, tokenizer_file: str, p: Packing = Packing()) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset), one row per piece.

    Every token of every row of ``docs`` is in exactly one piece; ids are
    little-endian unsigned 32-bit integers.  A sequence has ``window`` tokens or
    a smaller power of two, so none needs padding.  A null or empty text is the
    end token alone; repeated rows and rows with a null doc_id are packed like
    any other; no rows give no pieces.
    """
    if p.window < 1 or p.window & (p.window - 1):
        raise ValueError("the window is a power of two")
    tokens = scratch_table(tokenized(docs, tokenizer_file, p.end_id), "pack-tokens")
    total = tokens.filter("n >= 0").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens")).first()
    n_docs, n_tokens = total["docs"], total["tokens"] or 0
    mean = n_tokens / max(1, n_docs)
    df = document_frequencies(tokens)
    keyed = scratch_table(keyed_tokens(tokens, df, n_docs, mean, p), "pack-keys")  # the ranges are sampled from it
    shards = max(1, -(-n_tokens // p.shard_tokens))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    idf = docs.sparkSession.sparkContext.broadcast(_idf(df, n_docs))

    def shard_pieces(rows: list[tuple], base: int) -> pa.Table:
        rows.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2]))
        ids = [token_ids(x) for _, _, x in rows]
        sizes = [len(x) for x in ids]
        found = fill(sizes, Shard(ids, idf.value, mean, p), p.window)
        return pa.table([
            pa.array([rows[d][0] for d, *_ in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64()),
            pa.array([ids[d][s:s + n].tobytes() for d, s, n, _, _ in found], pa.binary()), pa.array([sizes[x[0]] for x in found], pa.int64()),
            pa.array([base + x[3] for x in found], pa.int64()), pa.array([x[4] for x in found], pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards of ``shard_tokens`` tokens in the order of the rows."""
        base, no = TaskContext.get().partitionId() << 44, 0
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids"))):
                if rows and held + row[1] > p.shard_tokens:
                    yield from shard_pieces(rows, base | no << 32).to_batches(max_chunksize=4096)
                    rows, held, no = [], 0, no + 1
                rows.append(row)
                held += row[1]
        if rows:
            yield from shard_pieces(rows, base | no << 32).to_batches(max_chunksize=4096)

    order = ["key", "key2", F.xxhash64("doc_id", "ids")]  # the last deals a hot key to several shards
    return keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "n", "ids") \
        .mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def padding(length, window: int = 2048):
    """Column: tokens of padding that a sequence of ``length`` tokens gets."""
    power = F.bit_count(length) == 1
    return F.when(power, F.lit(0)).otherwise(F.lit(window) - length)
