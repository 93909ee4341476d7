"""Pairs of users with very many items: the plain join's rows, made in many places."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from cograph.operators import graph as G

CONF = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def fixed(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def items(seed=0):
    r = random.Random(seed)
    rows = [("hot", i, r.random()) for i in range(400)] + [(f"u{u}", i, r.random()) for u in range(60) for i in r.sample(range(500), r.randint(1, 12))]
    return rows + [(None, 1, 0.5), (None, 2, 0.5)]


@pytest.mark.parametrize("keep_user", [False, True])
@pytest.mark.parametrize("block", [1, 7, 50, 399, 400, 10_000])
def test_the_rows_of_the_plain_join(spark, keep_user, block):
    ui = spark.createDataFrame(items(block), "user string, item int, weight double")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(G.contract_in_blocks(ui, keep_user, block)) == rows(G.contract_user_items(ui, keep_user))


def test_a_hot_user_is_spread(spark, fixed):
    """Without adaptive splitting: 400 items in groups of 25 make 136 cells."""
    ui = spark.createDataFrame(items(), "user string, item int, weight double").filter("user is not null")
    per_task = lambda df: [r.n for r in df.filter("user = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("weight")).select("p", "n").collect()]
    plain, blocked = per_task(G.contract_user_items(ui.repartition("user"), True)), per_task(G.contract_in_blocks(ui, True, 25))
    assert plain == [400 * 399 // 2] and sum(blocked) == plain[0]
    assert len(blocked) >= 20 and max(blocked) < plain[0] / 5


def test_uncapped_graph(spark):
    rows = items(3)
    ui = spark.createDataFrame(rows, "user string, item int, weight double")
    links, _ = G.build_item_item_graph(ui, 1.0, 0.0, None, block_items=30)
    import math
    want = {}
    by_user = {}
    for u, i, w in rows:
        if u is not None:
            by_user.setdefault(u, []).append((i, math.tanh(w / 2)))
    for own in by_user.values():
        for (i, a), (j, b) in itertools.permutations(own, 2):
            want[i, j] = want.get((i, j), 0.0) + min(a, b)
    got = {(r.item_A, r.item_B): r.weight for r in links.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_the_cap_keeps_the_plain_join_unless_it_is_large(spark):
    ui = spark.createDataFrame(items(), "user string, item int, weight double")
    plan = lambda cap: G.item_pairs(ui, cap, block_items=50)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan(50) and "explode" in plan(51) and "explode" in plan(None)


def test_cells_are_dealt_by_their_pairs(spark, monkeypatch):
    """More pairs, more tasks without a cap as with one; the links stay the same."""
    ui = spark.createDataFrame(items(5), "user string, item int, weight double")
    links = lambda: sorted((r.item_A, r.item_B, round(r.weight, 9)) for r in G.build_item_item_graph(ui, 1.0, 0.5, None, block_items=30)[0].collect())
    before, want = spark.conf.get(G.PARTITIONS_CONF, None), links()
    monkeypatch.setattr(G, "TASK_PAIRS", 1000)
    try:
        assert links() == want != []
        tasks = G.pair_tasks(G.aggregate_signals(ui, 1.0), None)
        assert tasks >= 400 * 399 // 2 // 1000 and int(spark.conf.get(G.PARTITIONS_CONF)) == tasks
        plan = G.contract_in_blocks(ui, block_items=30, tasks=tasks)._jdf.queryExecution().executedPlan().toString()
        assert f"user, x, y, {tasks}" in re.sub(r"#\d+", "", plan)
    finally:
        spark.conf.unset(G.PARTITIONS_CONF) if before is None else spark.conf.set(G.PARTITIONS_CONF, before)
