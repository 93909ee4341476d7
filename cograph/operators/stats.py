"""Quantiles.

Approximate mode: ``percentile_approx`` -- a mergeable sketch with map-side
partial aggregation, the default at scale.

Exact mode (linear interpolation between order statistics, like SQL
``quantile_cont``) without ever pulling a group into one task:
  0. the column is stored once, so every pass sees the same values;
  1. every wanted rank lies in an interval of values, at first the whole line;
     an interval with more than ``bucket_rows`` rows and more than one value is
     cut at approximate quantiles of its own rows, its parts are counted
     (Bucketizer, JVM side), and the part that holds the rank goes on.  Each
     round divides an interval by up to 1,000, so their number grows with
     log(n), and no last interval is larger than ``bucket_rows``;
  2. only those last intervals are expanded to a histogram of distinct values
     (a hot value collapses in a partial aggregate), whose running count locates
     the exact order statistics.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cograph.session import stored

TWENTY_ONE = [i / 20 for i in range(21)]  # min, 5 %, ..., 95 %, max


def _empty(df: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("quantile", T.DoubleType()),
                           T.StructField("value", T.DoubleType())])
    return df.sparkSession.createDataFrame([], schema)


def quantiles(df: DataFrame, col: str, qs: Sequence[float], exact: bool = False,
              accuracy: int = 10000, bucket_rows: int = 1_000_000, parts: int = 1000) -> DataFrame:
    """Rows (quantile, value) for each q in ``qs``.  The exact mode runs jobs
    while the plan is built: rounds that cut into ``parts`` until no more than
    ``bucket_rows`` rows have to be ranked together; it fails if a wanted rank
    is not found."""
    qs = [float(q) for q in qs]
    if any(not 0.0 <= q <= 1.0 for q in qs):
        raise ValueError("quantiles must lie in [0, 1]")
    v = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    if not exact:
        arr = v.agg(F.percentile_approx("v", F.array(*[F.lit(q) for q in qs]), accuracy).alias("a"))
        qarr = F.array(*[F.lit(q) for q in qs])
        return arr.select(F.inline(F.arrays_zip(qarr.alias("quantile"), F.col("a").alias("value"))))
    return _exact_quantiles(v, qs, accuracy, bucket_rows, parts)


def _exact_quantiles(v: DataFrame, qs: list[float], accuracy: int, bucket_rows: int, parts: int) -> DataFrame:
    spark = v.sparkSession
    v = stored(v, "quantiles")
    n = v.count()
    if n == 0:
        return _empty(v)
    wanted = {}  # (q, which) -> (rank, share of the upper value)
    for q in qs:
        pos = q * (n - 1)
        for which, rank in (("lo", math.floor(pos)), ("hi", math.ceil(pos))):
            wanted[q, which] = rank, pos - math.floor(pos)
    last = narrowed(v, sorted({r for r, _ in wanted.values()}), n, accuracy, bucket_rows, parts)
    spans = sorted(set(last.values()))
    rows = [(i, rank, rank - spans[i][2]) for rank, span in last.items() for i in [spans.index(span)]]
    # at most 2 * len(qs) rows: a fixed-size literal frame, safe to broadcast
    wdf = F.broadcast(spark.createDataFrame(rows, "b int, rank long, r long"))
    hist = v.withColumn("b", _which(spans)).filter("b is not null").groupBy("b", "v").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("end", F.sum("c").over(w)).withColumn("start", F.col("end") - F.col("c"))
    found = wdf.alias("w").join(hist.alias("h"), (F.col("w.b") == F.col("h.b")) & (F.col("w.r") >= F.col("h.start")) & (F.col("w.r") < F.col("h.end")))
    hit = {r["rank"]: r["v"] for r in found.select("w.rank", "h.v").collect()}  # two values per quantile
    if lost := [k for k, (rank, _) in wanted.items() if rank not in hit]:
        raise RuntimeError(f"ranks not found in their buckets: {lost}")
    lo, hi = ({q: hit[wanted[q, which][0]] for q in qs} for which in ("lo", "hi"))
    return spark.createDataFrame([(q, lo[q] + wanted[q, "lo"][1] * (hi[q] - lo[q])) for q in qs], _empty(v).schema)


def _which(spans: list[tuple]):
    """Number of the interval that holds ``v``, or null; the last one up to infinity holds it too."""
    return F.coalesce(*[F.when((F.col("v") >= low) & (F.lit(high == math.inf) | (F.col("v") < high)), F.lit(i)) for i, (low, high, *_) in enumerate(spans)])


def narrowed(v: DataFrame, ranks: list[int], n: int, accuracy: int, bucket_rows: int, parts: int) -> dict[int, tuple]:
    """For each 0-based rank among the ``n`` values ``v`` the interval (low,
    high, rows below, rows) that holds it, low <= v < high (or = infinity).  An interval has at
    most ``bucket_rows`` rows, or one value."""
    found = {r: (-math.inf, math.inf, 0, n) for r in ranks}
    small: set[tuple] = set()
    fracs = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    while True:
        wide = sorted({s for s in found.values() if s[3] > bucket_rows and s not in small})
        if not wide:
            return found
        rows = v.withColumn("s", _which(wide)).filter("s is not null")
        # an interval's approximate quantiles, and its extremes, which tell whether it has one value
        cuts = {r["s"]: r for r in rows.groupBy("s").agg(F.percentile_approx("v", fracs, accuracy).alias("cuts"), F.min("v").alias("a"), F.max("v").alias("b")).collect()}
        splits = {-math.inf, math.inf}
        for i, (low, high, _, _) in enumerate(wide):
            r = cuts[i]
            if r["a"] == r["b"]:
                small.add(wide[i])
                continue
            # the value after a cut begins a part too, so that a hot value becomes a part of its own
            inner = {x for c in r["cuts"] for x in (c, math.nextafter(c, math.inf)) if r["a"] < x <= r["b"]}
            splits |= {low, high} | (inner or {r["b"]})
        edges = sorted(splits)
        if len(edges) < 3:
            continue
        counted = Bucketizer(splits=edges, inputCol="v", outputCol="b").transform(rows).groupBy("s", "b").agg(F.count(F.lit(1)).alias("c")).collect()
        spans: dict[int, list[tuple]] = {}
        for r in sorted(counted, key=lambda r: (r["s"], r["b"])):
            own = spans.setdefault(r["s"], [])
            below = own[-1][2] + own[-1][3] if own else wide[r["s"]][2]
            own.append((edges[int(r["b"])], edges[int(r["b"]) + 1], below, r["c"]))
        for rank, span in found.items():
            if span in wide and span not in small:
                found[rank] = next(s for s in spans[wide.index(span)] if s[2] <= rank < s[2] + s[3])


def rank_bounds(df: DataFrame, col: str, found: DataFrame) -> DataFrame:
    """For rows (quantile, value): quantile, value and the ranks, as shares of
    the rows, of the values below and up to ``value`` (one row each per quantile)."""
    v = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    cuts = found.collect()  # one row per quantile
    if not cuts:
        return found.withColumns({"below": F.lit(0.0), "upto": F.lit(0.0)})
    share = lambda cond: F.avg(F.when(cond, 1.0).otherwise(0.0))
    each = v.select("v", F.explode(F.array(*[F.struct(F.lit(r["quantile"]).alias("quantile"), F.lit(r["value"]).alias("value")) for r in cuts])).alias("c"))
    return each.groupBy(F.col("c.quantile").alias("quantile"), F.col("c.value").alias("value")).agg(
        share(F.col("v") < F.col("c.value")).alias("below"), share(F.col("v") <= F.col("c.value")).alias("upto"))


def item_weight_quantiles(signals: DataFrame, exact: bool = False, accuracy: int = 10000) -> DataFrame:
    """21 quantiles (min, 5 %, ..., max) of unscaled item popularity, used
    to tune the Bayesian prior."""
    item_w = signals.groupBy("item").agg(F.sum("weight").alias("weight"))
    return quantiles(item_w, "weight", TWENTY_ONE, exact=exact, accuracy=accuracy)
