"""Per-group ranking helpers built on ``row_number`` windows.

``row_number() <= k`` over ``partitionBy(...).orderBy(...)`` is planned by Spark
as a WindowGroupLimit: a partial top-k runs on the map side *before* the
shuffle, so even a key holding a third of all rows sends at most k rows per map
task across the network.  Every ordering ends on a unique key so results do not
depend on input order (ties are broken explicitly, never by bag order).
"""

from __future__ import annotations

from typing import Sequence, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cograph.session import stored

Cols = Sequence[Union[str, Column]]


def _window(partition_by: Cols, order_by: Cols):
    return Window.partitionBy(*partition_by).orderBy(*order_by)


def rank_within(df: DataFrame, partition_by: Cols, order_by: Cols,
                rank_col: str = "rank") -> DataFrame:
    """1-based distinct ranks (Enumerate semantics, never rank/dense_rank)."""
    return df.withColumn(rank_col, F.row_number().over(_window(partition_by, order_by)))


LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_k(df: DataFrame, partition_by: Cols, order_by: Cols, k: int | None,
          rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group (``None``: all); optionally keep the rank.

    Spark plans the partial limit only for k up to a session setting, which is
    raised to a larger k."""
    if k is None:
        return rank_within(df, partition_by, order_by, rank_col) if rank_col else df
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = df.sparkSession
    if k > int(spark.conf.get(LIMIT_CONF, "1000")) >= 0:
        spark.conf.set(LIMIT_CONF, str(k))
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(_window(partition_by, order_by))).filter(
        F.col(name) <= k)
    return out if rank_col else out.drop(name)


def latest_by(df: DataFrame, keys: Cols, order_by: Cols) -> DataFrame:
    """Arg-max per key -- the single first row of each group under ``order_by``."""
    return top_k(df, keys, order_by, 1)


def distributed_rank(df: DataFrame, group_by: Sequence[str], order_by: Cols, rank_col: str = "rank") -> DataFrame:
    """`rank_within` for groups of any size: ``df`` with each row's 1-based rank
    (a long) in its group, where no task holds a whole group.

    The rows are dealt into ranges of (group, order) and stored, so that every
    later step sees the same ranges.  A row's rank is its number among the rows
    of its group in its range, plus the rows of that group in earlier ranges.
    Only the first group of a range can have rows in an earlier one, so the
    table of these sums has at most one row per range and is broadcast.  Rows
    that are equal under ``order_by`` are ranked in an unspecified order.  Null
    group values form a group.  ``order_by`` and all columns must be known to
    ``df``; the table is written when this is called.
    """
    row, part, n, before = "__row", "__part", "__n", "__before"
    order = [F.col(g).asc_nulls_first() for g in group_by] + list(order_by)
    dealt = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn(row, F.monotonically_increasing_id()), "ranked")
    dealt = dealt.withColumn(part, F.shiftright(row, 33))  # the id holds the range above 33 bits of the row's number
    group = F.struct(*group_by, F.lit(0).alias("__no_group")) if group_by else F.struct(F.lit(0).alias("__no_group"))
    runs = dealt.groupBy(part, *group_by).agg(F.count(F.lit(1)).alias(n), F.min(row).alias("__first"))
    run = F.struct(group.alias("g"), F.col(n).alias("n"))
    ends = runs.groupBy(part).agg(F.min_by(run, "__first").alias("a"), F.max_by(run, "__first").alias("b")) \
        .select(part, F.explode(F.array_distinct(F.array("a", "b"))).alias("r")).select(part, "r.g", "r.n")
    earlier = F.sum("n").over(Window.partitionBy("g").orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn(before, earlier).filter(F.col(before) > 0).select(
        F.col(part).alias("__p"), *[F.col(f"g.{g}").alias(f"__g{i}") for i, g in enumerate(group_by)], before)
    on = F.col(part) == F.col("__p")
    for i, g in enumerate(group_by):
        on &= F.col(g).eqNullSafe(F.col(f"__g{i}"))
    local = F.row_number().over(Window.partitionBy(part, *group_by).orderBy(row))
    return dealt.withColumn(rank_col, local).join(F.broadcast(ends), on, "left").select(
        *df.columns, (F.col(rank_col) + F.coalesce(before, F.lit(0))).cast("long").alias(rank_col))
