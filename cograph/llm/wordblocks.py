"""Blocks of texts cut into the pattern's words with numpy, so that each
distinct word is encoded once however often it occurs.

The cut is that of the public byte-level pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import regex
import xxhash

OTHER, LETTER, NUMBER, SPACE = range(4)
MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
CHUNK_CHARS = 1 << 19
CACHE_WORDS = 1_000_000
CACHE_CHARS = 1 << 24
LONG_SPAN = 256  # a polynomial modulo 2**64 has equal values for different spans of some 1,000 values


@lru_cache(None)
def char_classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            table[m.start():m.end()] = kind
    return table


def word_starts(codes: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Positions where words begin; no word crosses a position of ``doc_starts``."""
    n = len(codes)
    kind = char_classes()[codes]
    first = np.zeros(n + 3, bool)
    first[doc_starts] = True
    first[n:] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    # the last of several spaces before a word is not part of their run
    tail = np.flatnonzero(white[:-1] & ~white[1:] & ~first[1:n])
    start[tail] = True
    # and a plain space belongs to what follows it
    start[tail[codes[tail] == 32] + 1] = False
    quote = np.flatnonzero((codes == 39) & start)
    if len(quote):
        padded = np.concatenate((codes, np.zeros(3, codes.dtype)))
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"]) & ~first[quote + 1]
        pair = one.astype(np.int64) << 32 | two
        long = np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]) & ~first[quote + 1] & ~first[quote + 2]
        start[quote[short | long] + 1] = False
        ends = np.concatenate((quote[short] + 2, quote[long] + 3))
        start[ends[ends < n]] = True
    return np.flatnonzero(start)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, MULTIPLIER, np.uint64), np.full(n, pow(MULTIPLIER, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``codes[start:end]``, equal for equal contents; contents
    of equal hashes may differ."""
    n = len(codes)
    up, down = _powers(1 << max(20, n.bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(ends - starts >= LONG_SPAN).tolist():
        h[i] = xxhash.xxh64_intdigest(codes[starts[i]:ends[i]].tobytes())
    return h


class WordEncoder:
    """Token ids of texts through ``encode_words``, which gets each new distinct
    word of a block once: list of words -> (ids of all words, end of each word's ids).

    Words are found again by their hashes, and every one is compared with the
    known word character by character; one that differs goes by its text.
    """

    def __init__(self, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode_words = encode_words
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int32)
        self.chars = np.zeros(1 << 16, np.uint32)  # of the known words, one after the other
        self.bounds = np.zeros(1, np.int64)  # begin of word i in ``chars``, end of word i - 1
        self.others: dict[str, int] = {}  # words whose hash another one has
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)  # of word i - 1

    def _learn(self, codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        sizes = stops - starts
        ends = np.cumsum(sizes)
        used, more = int(self.bounds[-1]), int(ends[-1]) if len(ends) else 0
        if used + more > len(self.chars):
            self.chars = np.concatenate((self.chars, np.zeros(max(len(self.chars), more), np.uint32)))
        self.chars[used:used + more] = codes[np.repeat(starts - (ends - sizes), sizes) + np.arange(more)]
        self.bounds = np.concatenate((self.bounds, used + ends))

    def _differ(self, codes: np.ndarray, starts: np.ndarray, stops: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Words (which together are all of ``codes``) that are not the known word of their number."""
        begin, sizes = self.bounds[numbers], stops - starts
        wrong = self.bounds[numbers + 1] - begin != sizes
        at = np.arange(len(codes)) + np.repeat(begin - starts, sizes)
        apart = np.flatnonzero(self.chars[np.minimum(at, len(self.chars) - 1)] != codes)
        wrong[np.searchsorted(starts, apart, "right") - 1] = True
        return np.flatnonzero(wrong)

    def _words(self, texts: list[str], new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of each word, words of each text)."""
        joined = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        if not joined:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = word_starts(codes, bounds[:-1][sizes > 0])
        stops = np.concatenate((starts[1:], [len(codes)]))
        hashes = span_hashes(codes, starts, stops)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == distinct[inside]
        numbers = np.empty(len(distinct), np.int32)
        numbers[known] = self.numbers[place[known]]
        fresh = np.flatnonzero(~known)
        numbers[fresh] = len(self.bounds) - 1 + np.arange(len(fresh))
        self._learn(codes, starts[at[fresh]], stops[at[fresh]])
        for s, e in zip(starts[at[fresh]].tolist(), stops[at[fresh]].tolist()):
            new.append(joined[s:e])
        self.hashes = np.insert(self.hashes, place[fresh], distinct[fresh])
        self.numbers = np.insert(self.numbers, place[fresh], numbers[fresh])
        found = numbers[inverse]
        for i in self._differ(codes, starts, stops, found).tolist():
            word = joined[starts[i]:stops[i]]
            if word not in self.others:
                self.others[word] = len(self.bounds) - 1
                self._learn(codes, starts[i:i + 1], stops[i:i + 1])
                new.append(word)
            found[i] = self.others[word]
        return found, np.diff(np.searchsorted(starts, bounds))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Token ids of each text, as unsigned 32-bit integers."""
        if len(self.bounds) > CACHE_WORDS or self.bounds[-1] > CACHE_CHARS:
            self._forget()
        new: list[str] = []
        chunks, held, size = [], [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= CHUNK_CHARS:
                chunks.append(self._words(held, new))
                held, size = [], 0
        if held:
            chunks.append(self._words(held, new))
        if new:
            ids, ends = self.encode_words(new)
            self.ends = np.concatenate((self.ends, ends + len(self.ids)))
            self.ids = np.concatenate((self.ids, ids))
        for numbers, counts in chunks:
            begin, length = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
            stop = np.cumsum(length)
            flat = self.ids[np.repeat(begin - (stop - length), length) + np.arange(int(stop[-1]) if len(stop) else 0)]
            stop = np.concatenate(([0], stop))
            cuts = stop[np.concatenate(([0], np.cumsum(counts)))]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                yield flat[a:b]
