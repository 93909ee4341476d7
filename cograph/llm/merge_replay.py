"""Byte-level BPE encoding and decoding by replaying the merges over a corpus.

The distinct words of a block of documents form one array of byte tokens.  An
inverted index holds, for each merge rank, the positions whose pair it merges;
ranks are applied in order to all words at once, and only the two neighbours of
a merged pair are looked up again.  Within a word the leftmost pair of the
lowest rank goes first, as in the tiktoken library.  A word of over
``LONG_WORD`` bytes, such as a run of letters, has an index of its own.

A block is the part of the corpus that one task holds (``BLOCK_BYTES`` of whole
texts): merge ranks are fixed, so an index over all words of the corpus would
give the same ids, but its way back to the documents would shuffle every word.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cograph.llm.common import blocks, small_batches, texts_of
from cograph.llm.wordblocks import WordEncoder

BLOCK_BYTES = 16 << 20
NEVER = np.int32(1 << 30)
LONG_WORD = 256  # bytes; a longer word is replayed by itself


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from the lines ``base64(token) rank`` of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class MergeTable:
    """Rank of the token that each mergeable pair of tokens forms."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        keys, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(1) << 62)
        self.made = np.append(np.array(made, np.int32)[order], NEVER)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.asarray(left, np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], NEVER)

    @cached_property
    def pairs(self) -> dict[int, int]:
        return dict(zip(self.keys[:-1].tolist(), self.made[:-1].tolist()))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, end of each word's ids)."""
        raw = [w.encode() for w in words]
        long = [i for i, w in enumerate(raw) if len(w) > LONG_WORD]
        if not long:
            return self.replay(raw)
        ids, ends = self.replay([w for w in raw if len(w) <= LONG_WORD])
        parts, counts, at = [], [], 0
        bounds = np.concatenate(([0], ends))
        for i, stop in zip([*long, len(raw)], [*(i - n for n, i in enumerate(long)), len(raw) - len(long)]):
            parts.append(ids[bounds[at]:bounds[stop]])  # the short words up to the next long one
            counts.append(np.diff(bounds[at:stop + 1]))
            at = stop
            if i < len(raw):
                parts.append(np.array(self.merge_long(raw[i]), np.uint32))
                counts.append(np.array([len(parts[-1])], np.int64))
        return np.concatenate(parts), np.cumsum(np.concatenate(counts))

    def merge_long(self, raw: bytes) -> list[int]:
        """The ids of one word, whose pairs wait in a heap by rank and place: the
        time grows with the length, not with its square."""
        pairs = self.pairs
        token = self.byte_ids[np.frombuffer(raw, np.uint8)].tolist()
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.rank(token[:-1], token[1:]).astype(np.int64)
        queue = ((first << 32) | np.arange(n - 1))[first < NEVER].tolist()
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            if token[i] < 0 or j >= n or pairs.get(token[i] << 32 | token[j]) != rank:
                continue  # one of the two has changed meanwhile
            token[i], token[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                made = pairs.get(rank << 32 | token[k])
                if made is not None:
                    heapq.heappush(queue, made << 32 | i)
            h = before[i]
            if h >= 0:
                made = pairs.get(token[h] << 32 | rank)
                if made is not None:
                    heapq.heappush(queue, made << 32 | h)
        return [t for t in token if t >= 0]

    def replay(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that are replayed together."""
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        token = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        n = len(token)
        token = np.append(token, np.int32(-1))
        word = np.repeat(np.arange(len(raw), dtype=np.int32), sizes)
        after = np.arange(1, n + 2, dtype=np.int32)
        last = np.cumsum(sizes)[sizes > 0] - 1
        after[last] = n
        before = np.arange(-1, n, dtype=np.int32)
        before[last[:-1] + 1] = -1
        alive = np.ones(n, bool)
        pair = np.full(n + 1, NEVER)  # rank of the pair that begins here
        inner = np.flatnonzero(after[:n] < n)
        small, where = np.unique(token[inner].astype(np.int64) << 32 | token[inner + 1], return_inverse=True)
        pair[inner] = self.rank(small >> 32, small & 0xFFFFFFFF)[where]

        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def add(positions: np.ndarray) -> None:
            ranks = pair[positions]
            if len(positions) > 1:
                order = np.argsort(ranks, kind="stable")
                positions, ranks = positions[order], ranks[order]
                cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                parts = np.split(positions, cuts) if len(cuts) else [positions]
                heads = ranks[np.concatenate(([0], cuts))].tolist()
            else:
                parts, heads = [positions], ranks.tolist()
            for r, part in zip(heads, parts):
                if r in index:
                    index[r].append(part)
                elif r < NEVER:
                    index[r] = [part]
                    heapq.heappush(queue, r)

        add(inner[pair[inner] < NEVER])
        while queue:
            rank = heapq.heappop(queue)
            held = index.pop(rank)
            at = held[0] if len(held) == 1 else np.concatenate(held)
            at = np.unique(at[pair[at] == rank])
            if not len(at):
                continue
            if len(at) > 1:  # one pair of a word at a time
                w = word[at]
                again = np.flatnonzero(w[1:] == w[:-1]) + 1
                if len(again):
                    index[rank] = [at[again]]
                    heapq.heappush(queue, rank)
                    at = np.delete(at, again)
            gone = after[at]
            beyond = after[gone]
            token[at] = rank
            alive[gone] = False
            pair[gone] = NEVER
            after[at] = beyond
            before[beyond] = at  # the entry of the end mark is never read
            pair[at] = np.where(beyond < n, self.rank(rank, token[beyond]), NEVER)
            left = before[at]
            inside = left >= 0
            left = left[inside]
            pair[left] = self.rank(token[left], rank)
            touched = np.concatenate((at, left))
            touched = touched[pair[touched] < NEVER]
            if len(touched):
                add(touched)
        ends = np.cumsum(np.bincount(word[alive], minlength=len(raw)))
        return token[:n][alive].astype(np.uint32), ends


def decode_ids(ids: bytes, token) -> bytes:
    return b"".join(map(token, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, rank_file: str, round_trip: bool = False) -> DataFrame:
    """(doc_id, ids), one row per row of ``docs``: the ids of the whole text as
    little-endian unsigned 32-bit integers, each word of the pattern encoded
    separately, no special tokens.  With ``round_trip`` also ``decoded``, the
    bytes that the ids decode to.  Null and empty texts have no ids; repeated
    rows and null doc_ids keep their rows."""
    with open(rank_file, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file, under 1 MB

    names = ["doc_id", "ids", "decoded"][:2 + round_trip]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(data.value)
        token = {rank: t for t, rank in ranks.items()}.__getitem__
        encoder = WordEncoder(MergeTable(ranks).encode_words)
        for block in blocks(batches, "text", BLOCK_BYTES):
            doc_ids = block.column("doc_id").combine_chunks()
            at, held, size = 0, [], 0
            texts = block.column("text").to_pylist()
            del block
            for i, ids in enumerate(encoder.encode(texts)):
                held.append(ids.tobytes())
                size += len(held[-1])
                if size > 4 << 20 or i + 1 == len(texts):
                    columns = [doc_ids.slice(at, len(held)), pa.array(held, pa.binary())]
                    if round_trip:
                        columns.append(pa.array([decode_ids(x, token) for x in held], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    at, held, size = i + 1, [], 0

    small_batches(docs.sparkSession)
    return texts_of(docs).mapInArrow(run, "doc_id long, ids binary" + ", decoded binary" * round_trip)


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes that the ids stand for; null ids decode to null."""
    with open(rank_file, "rb") as f:
        data = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: t for t, rank in read_ranks(data.value).items()}.__getitem__
        for b in batches:
            texts = [None if x is None else decode_ids(x, token) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    small_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids, decoded)."""
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
