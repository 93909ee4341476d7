"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; each window of w consecutive
hashes contributes its minimum, the rightmost on ties.  Any common run of at
least w + k - 1 code points then leaves a common hash in both fingerprints, and
no run shorter than k is ever matched.  With k = 8 and w = 16 that is any run of
23 code points, so the first half of every text of 46 or more.  Hashes and positions are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cograph.llm.common import small_batches, texts_of

BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Winnowing:
    k: int = 8
    w: int = 16


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """32-bit hash of every run of ``k`` code points.

    Polynomial hashes of runs of doubling length are joined to length k, so the
    whole array is rolled at once.
    """
    base = BASE
    run = codes.astype(np.uint64) + np.uint64(1)  # hash of runs of length 1
    length, total, done = 1, None, 0
    factor = {1: base}
    while True:
        if k & length:
            total = run if total is None else total[:len(run[done:])] * np.uint64(factor[length]) + run[done:][:len(total)]
            done += length
        if 2 * length > k:
            break
        n = len(run) - length
        run = run[:n] * np.uint64(factor[length]) + run[length:]
        factor[2 * length] = factor[length] ** 2 % (1 << 64)
        length *= 2
    n = len(codes) - k + 1
    h = total[:n]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype(np.uint32)


def select(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions of the window minima, rightmost on ties; one window if there are fewer than w hashes."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    w = min(w, n)
    # smaller hash first, then the larger position: one minimum per window
    ranked = hashes.astype(np.uint64) << np.uint64(32) | np.arange(n, dtype=np.uint64)[::-1]
    reach = 1
    low = ranked
    while 2 * reach <= w:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < w:
        shift = w - reach
        low = np.minimum(low[:len(low) - shift], low[shift:])
    kept = low[np.concatenate(([True], low[1:] != low[:-1]))]
    return n - 1 - (kept & np.uint64(0xFFFFFFFF)).astype(np.int64)


def winnow(codes: np.ndarray, p: Winnowing) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a text; a text shorter than k is one gram, an empty one has none."""
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    hashes = gram_hashes(codes, min(p.k, len(codes)))
    at = select(hashes, p.w)
    return hashes[at], at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the hash sets of two fingerprints; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def fingerprints(docs: DataFrame, p: Winnowing = Winnowing()) -> DataFrame:
    """(doc_id, hashes array<long>, positions array<int>), one row per row of
    ``docs``; null and empty texts have empty arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [winnow(code_points(t), p) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                pa.array([x.astype(np.int32) for _, x in found], pa.list_(pa.int32()))], names=["doc_id", "hashes", "positions"])

    small_batches(docs.sparkSession)
    return texts_of(docs).mapInArrow(run, "doc_id long, hashes array<bigint>, positions array<int>")


def with_next(docs: DataFrame, rows_per_bucket: int = 4_000, most_buckets: int = 100_000) -> DataFrame:
    """Rows (bucket, lead, doc_id, text) whose order by bucket, lead and
    descending doc_id is that of the documents; each bucket ends with a row
    ``lead`` = true: the first document of the next bucket, or for the last
    bucket the first of all.

    The cut points (at most ``most_buckets`` numbers, any of which give the
    same order) come from approximate quantiles; buckets are streamed, so their
    size does not bound memory.  Rows of one doc_id are ordered by text; null
    doc_ids come last.
    """
    from pyspark.ml.feature import Bucketizer

    texts = texts_of(docs)
    spark = docs.sparkSession
    parts = min(most_buckets, max(1, -(-texts.count() // rows_per_bucket)))
    cuts = sorted(set(texts.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 1 / (4 * parts)))) if parts > 1 else []
    cut = Bucketizer(splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol="place", outputCol="range")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 2)).otherwise(F.lit(len(cuts) + 1) - F.col("range")).cast("int")
    rows = cut.transform(texts.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)))).select("doc_id", "text", bucket.alias("bucket"))
    # the first document of each bucket: largest doc_id, then smallest text
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).orderBy("bucket").collect()
    if not tops:
        return rows.select("bucket", F.lit(False).alias("lead"), "doc_id", "text")
    into = {tops[(i + 1) % len(tops)]["bucket"]: t["bucket"] for i, t in enumerate(tops)}
    ends = spark.createDataFrame([(t["bucket"], into[t["bucket"]], t["top"]) for t in tops], "bucket int, into int, top long")
    first = rows.join(F.broadcast(ends), "bucket").filter(F.col("doc_id").eqNullSafe(F.col("top"))) \
        .groupBy("into").agg(F.min(F.struct("text", "doc_id")).alias("r"))
    leads = first.select(F.col("into").alias("bucket"), F.lit(True).alias("lead"), F.col("r.doc_id").alias("doc_id"), F.col("r.text").alias("text"))
    return rows.select("bucket", F.lit(False).alias("lead"), "doc_id", "text").union(leads)


def edited_fingerprints(docs: DataFrame, p: Winnowing = Winnowing()) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, hashes, positions, edited_hashes, edited_positions, near_edited, near_next).

    The next document of a row is the one after it in descending doc_id, the
    first of all after the last.  The edited text keeps the first half (rounded
    up) of the row's code points and takes its rest from the beginning of the
    next text, as far as that reaches.  near_edited and near_next are the
    likenesses of the fingerprint to that of the edited text and of the next
    document.  Null texts are empty; rows of one doc_id are ordered by text,
    null doc_ids come last; a single row is its own next document.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("hashes", pa.binary()), ("positions", pa.list_(pa.int32())), ("edited_hashes", pa.binary()), ("edited_positions", pa.list_(pa.int32())),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (bucket, doc_id, text, hashes, positions)
        out: list[tuple] = []
        size = 0
        for b in batches:
            for bucket, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "doc_id", "text"))):
                hashes, at = winnow(code_points(text), p)
                if before is not None and before[0] == bucket:
                    _, own, old, h, x = before
                    half = len(old) // 2
                    edited = old[:len(old) - half] + text[:half]
                    eh, ex = winnow(code_points(edited), p)
                    out.append((own, len(old), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                h.astype(">u4").tobytes(), x.astype(np.int32), eh.astype(">u4").tobytes(), ex.astype(np.int32),
                                likeness(h, eh), likeness(h, hashes)))
                    size += len(h) * 16
                    if len(out) >= 1024 or size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out, size = [], 0
                before = (bucket, doc_id, text, hashes, at)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    spark = docs.sparkSession
    small_batches(spark)
    rows = with_next(docs).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket") \
        .sortWithinPartitions(F.asc("bucket"), F.asc("lead"), F.desc_nulls_last("doc_id"), F.asc("text"))
    return rows.select("bucket", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, hashes binary, positions array<int>, "
             "edited_hashes binary, edited_positions array<int>, near_edited double, near_next double")
