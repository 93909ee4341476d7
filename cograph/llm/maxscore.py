"""Exact top-k inner-product search by MaxScore over sharded inverted indexes.

Terms are vector dimensions.  A shard keeps, for each dimension, the values of
its vectors in the order of their ids, with the extreme values.  For a query,
every dimension's contribution is counted from its lowest value in the shard,
so contributions are not negative and have an upper bound.  Dimensions whose
bounds sum to no more than the current k-th score are non-essential: postings
of the essential ones are traversed, the others are probed from the largest
bound on, only for vectors that can still enter.  Shards merge by a window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cograph.llm.common import shuffle_partitions

BLOCK = 1024  # postings traversed between two updates of the threshold
PROBES = 4  # non-essential dimensions probed at once


class Shard:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        """``ids`` ascending, one row of ``vectors`` each."""
        self.ids, self.postings = ids, np.ascontiguousarray(vectors.T)
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best vectors other than ``query_id``'s, score descending, then id."""
        terms = np.flatnonzero(query)
        q = query[terms]
        a, b = q * self.low[terms], q * self.high[terms]
        floor, bound = np.minimum(a, b), np.abs(a - b)
        order = np.argsort(bound, kind="stable")
        terms, q, floor, bound = terms[order], q[order], floor[order], bound[order]
        below = np.concatenate(([0], np.cumsum(bound)))  # most that the first i terms can add
        base = int(floor.sum())
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = -1  # a vector must score more: equal ones met later have larger ids
        for begin in range(0, len(self.ids), BLOCK):
            at = np.arange(begin, min(begin + BLOCK, len(self.ids)))
            first = min(int(np.searchsorted(below, least, "right")) - 1, len(terms)) if least >= 0 else 0
            part = q[first:] @ self.postings[terms[first:], begin:begin + len(at)] - floor[first:].sum()
            end = first
            while True:
                alive = part + below[end] > least
                at, part = at[alive], part[alive]
                if end == 0 or not len(at):
                    break
                start = max(0, end - PROBES)
                part = part + q[start:end] @ self.postings[terms[start:end]][:, at] - floor[start:end].sum()
                end = start
            own = self.ids[at] != query_id
            rows, scores = np.concatenate((rows, at[own])), np.concatenate((scores, part[own]))
            best = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[best], scores[best]
            if len(rows) == k:
                least = int(scores[-1])
        return rows, scores + base


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def _ordered(table: pa.Table) -> tuple[np.ndarray, list]:
    """Ids ascending and their vectors, of every row."""
    rows = sorted(zip(table.column("vec_id").to_pylist(), table.column("vector").to_pylist()))
    return np.array([r[0] for r in rows], np.int64), [r[1] for r in rows]


def integer_vectors(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, vector array<long>): floor(scale * x) of every component; rows
    with a null id, a null vector or a null or non-finite component are left out."""
    x = F.col("embedding")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")) \
        .filter(F.col("vec_id").isNotNull() & x.isNotNull() & whole) \
        .select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("vector"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 16_384, query_rows: int = 16_384) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k rows of
    ``vectors`` (vec_id long, vector array<long>) with the highest inner
    product, ties to the smaller vec_id, never the query's own id.

    Shorter vectors count as padded with zeros.  Rows that repeat a vec_id are
    candidates of their own; queries that repeat one share its ``k`` rows, the
    best of any of them, and equal pairs count each time.  Fewer than k candidates give as many rows; no
    queries or no candidates give none.  The query set meets all shards in
    blocks of at most ``query_rows`` queries and ``shard_rows`` vectors.
    """
    spark = vectors.sparkSession
    n, m = vectors.count(), queries.count()
    shards = max(1, -(-n // shard_rows), min(shuffle_partitions(spark), n // 1024))
    groups = max(1, -(-m // query_rows))

    def deal(df: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return df.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()), F.lit(parts)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other))

    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, rows = _ordered(left)
        query_ids, asked = _ordered(right)
        width = max(1, max(map(len, rows)), max(map(len, asked)))
        shard = Shard(ids, _matrix(rows, width))
        out = []
        for query_id, q in zip(query_ids.tolist(), _matrix(asked, width)):
            at, scores = shard.top(query_id, q, k)
            out.append((np.full(len(at), query_id, np.int64), shard.ids[at], scores))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    left = deal(vectors, "shard", shards, "part", groups).groupBy("shard", "part")
    right = deal(queries, "part", groups, "shard", shards).groupBy("shard", "part")
    found = left.cogroup(right).applyInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
