"""Pairs summed from lists, in rounds: the links of the plain join, with few pairs on disk at once."""

import random

import pytest
from pyspark.sql import functions as F

from cograph.operators import graph as G


def signals(spark, kind):
    r = random.Random(4)
    rows = [(u, 10**12 + 3 * i, r.choice([1.0, 2.0, 5.0])) for u in range(50) for i in r.sample(range(60), r.randint(1, 25))]
    rows += [(u, 10**12, 1.0) for u in range(50)] + [(None, 10**12, 1.0), (3, None, 1.0)]
    return spark.createDataFrame(rows, "user int, item long, weight double").withColumn("item", F.col("item").cast(kind))


def shown(links):
    return sorted((str(r.item_A), str(r.item_B), round(r.weight, 9)) for r in links.collect())


@pytest.mark.parametrize("kind,cap,block", [("long", 10, 2048), ("string", 10, 2048), ("string", 10, 4), ("long", None, 7)])
def test_rounds_and_hot_items_give_the_plain_links(spark, monkeypatch, kind, cap, block):
    sig = signals(spark, kind)
    links = lambda: shown(G.build_item_item_graph(sig, 1.0, 1.5, cap, block)[0])
    want = links()
    before = spark.conf.get(G.PARTITIONS_CONF, None)
    written = []
    real = G.stored_in_parts
    monkeypatch.setattr(G, "stored_in_parts", lambda parts, name: real((written.append(name) or p for p in parts), name))
    monkeypatch.setattr(G, "TASK_PAIRS", 100)
    monkeypatch.setattr(G, "SUM_PAIRS", 100)
    monkeypatch.setattr(G, "ROUND_PAIRS", 400)
    try:
        assert links() == want != []
        assert len(written) >= 3
    finally:
        spark.conf.unset(G.PARTITIONS_CONF) if before is None else spark.conf.set(G.PARTITIONS_CONF, before)


def test_a_pair_is_no_row_of_the_exchange(spark):
    """The rows that are shuffled are one per user and item, not one per pair; a hot item's are spread by both items."""
    ui = G.aggregate_signals(signals(spark, "long"), 1.0)
    lists = G.user_lists(ui, 20)
    sizes = [len(r["items"]) for r in lists.collect()]
    summed = G.sum_listed_pairs(lists, 3)
    assert summed.rdd.getNumPartitions() == 3
    plain = G.contract_user_items(G.top_links_per_user(ui, 20)).groupBy("item_A", "item_B").agg(F.sum("weight").alias("weight"))
    assert shown(summed) == shown(plain)
    assert sum(n * (n - 1) // 2 for n in sizes) > 3 * sum(sizes)
    hot = spark.createDataFrame([(10**12,), (10**12 + 3,)], "item long")
    assert shown(G.sum_listed_pairs(lists, 3, hot=hot)) == shown(plain)
    halves = [F.pmod(F.xxhash64("item"), F.lit(2)) == r for r in range(2)]
    assert sorted(shown(G.sum_listed_pairs(lists, 3, halves[0])) + shown(G.sum_listed_pairs(lists, 2, halves[1], hot))) == shown(plain)


def test_rounds_follow_the_pairs_not_the_shuffle_partitions(spark, monkeypatch):
    sig = signals(spark, "long")
    before = {c: spark.conf.get(c, None) for c in (G.PARTITIONS_CONF, "spark.sql.shuffle.partitions")}
    written = []
    real = G.stored_in_parts
    monkeypatch.setattr(G, "stored_in_parts", lambda parts, name: real((written.append(name) or p for p in parts), name))
    monkeypatch.setattr(G, "TASK_PAIRS", 300)
    monkeypatch.setattr(G, "ROUND_PAIRS", 20_000)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        G.build_item_item_graph(sig, 1.0, 1.5, 10)
        assert len(written) == 1
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
