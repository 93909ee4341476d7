"""Ranks counted over ranges: the plain window's ranks, no group in one task."""

import random

import pytest
from pyspark.sql import Window, functions as F

from cograph.functions.ranking import distributed_rank
from cograph.operators import graph as G


@pytest.mark.parametrize("groups", [["g"], ["g", "h"], []])
def test_same_ranks_as_a_window(spark, groups):
    r = random.Random(len(groups))
    rows = [(r.choice([7, 7, 7, 7, 1, 2, None]), r.choice(["a", None]), r.choice([None, 0.5, 1.0, r.random()]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, h string, w double, i int").repartition(7)
    order = [F.desc_nulls_last("w"), F.asc("i")]
    got = distributed_rank(df, groups, order, "rank")
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)).cast("long"))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_empty_and_single(spark):
    df = spark.createDataFrame([], "g int, i int")
    assert distributed_rank(df, ["g"], ["i"]).collect() == []
    one = spark.createDataFrame([(None, 3)], "g int, i int")
    assert [tuple(r) for r in distributed_rank(one, ["g"], ["i"]).collect()] == [(None, 3, 1)]


def test_a_hot_group_is_split(spark):
    """A third of the rows in one group: the windows count within ranges of it."""
    conf = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.localShuffleReader.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 60_000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("g"), F.xxhash64("id").alias("w"))
        ranked = distributed_rank(df, ["g"], ["w"])
        tasks = ranked.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("rank").alias("r")).agg(F.max("n"), F.max("r")).first()[0]
        assert tasks < 12_000  # 20,000 rows are in the group
        assert ranked.filter("g = -1").agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first() == (1, 20_000, 20_000)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_diversity_with_a_common_value(spark):
    links = spark.range(0, 4000).select((F.col("id") % 2).alias("item_A"), F.col("id").alias("item_B"), (F.col("id") % 50 + 1.0).alias("weight"), F.lit(1.0).alias("raw_weight"))
    meta = spark.range(0, 4000).select(F.col("id").alias("item"), F.when(F.col("id") % 3 != 0, "common").otherwise(F.col("id").cast("string")).alias("metadata_field"))
    got = {(r.item_A, r.item_B): r.weight for r in G.diversify_links(links, meta).collect()}
    want = {}
    for a in (0, 1):
        common = sorted((i for i in range(a, 4000, 2) if i % 3), key=lambda i: (-(i % 50 + 1.0), i))
        want |= {(a, i): (i % 50 + 1.0) / k for k, i in enumerate(common, 1)}
        want |= {(a, i): i % 50 + 1.0 for i in range(a, 4000, 2) if i % 3 == 0}
    assert got == want
