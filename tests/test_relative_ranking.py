"""Rankings hold for weights of any size, and do not depend on partitions."""

import random

import pytest
from pyspark.sql import functions as F

from cograph.functions.ranking import top_k
from cograph.functions.scale import significant
from cograph.operators import graph as G
from cograph.operators import neighbours as N
from cograph.operators.graph import bayes_adjust, build_item_item_graph, diversify_links
from cograph.params import RecParams
from cograph.plans import recommenders as R

LINKS = "item_A string, item_B string, weight double, raw_weight double"


def test_quality_adjusted_links_of_popular_items(spark):
    links = spark.createDataFrame([("a", "x", 1.25), ("a", "y", 1.55)], "item_A string, item_B string, weight double")
    weights = spark.createDataFrame([("x", 1e6), ("y", 1e6)], "item string, overall_weight double")
    quality = spark.createDataFrame([("x", 0.5), ("y", 0.5)], "item string, quality_score double")
    adj = G.quality_adjust(links, weights, quality, 0.00227, 7.39)
    got = N.direct_neighbours(adj, 5).orderBy("rank").collect()
    assert [r.item_B for r in got] == ["y", "x"] and got[0].weight < 1e-9


def test_direct_ranks_of_tiny_weights(spark):
    links = spark.createDataFrame([("a", "p", 2e-10, 1.0), ("a", "q", 4e-10, 1.0), ("a", "r", 3e-10, 1.0)], LINKS)
    assert [r.item_B for r in N.direct_neighbours(links, 3).orderBy("rank").collect()] == ["q", "r", "p"]


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e30])
def test_two_hop_keeps_the_stronger_link(spark, scale):
    links = spark.createDataFrame([("a", "p", 2e-11 * scale, 1.0), ("a", "q", 9e-11 * scale, 1.0)], LINKS)
    assert [r.item_B for r in N.two_hop_neighbours(links, 1, 5).collect()] == ["q"]


def test_values_equal_but_for_summation_noise_tie(spark):
    a = 0.0
    for _ in range(10):
        a += 0.1
    rows = spark.createDataFrame([("u", "b", 1.0), ("u", "a", a), ("u", "c", 1.0 + 1e-6)], "user string, item string, weight double")
    got = G.top_links_per_user(rows, 3, "rank").orderBy("rank").collect()
    assert a != 1.0 and [r.item for r in got] == ["c", "a", "b"]


def test_significant_bits(spark):
    values = [0.0, -0.0, 1.0, 1 / 3, -1 / 3, 1e-300, 1e300, 12345.678, None]
    got = [r.s for r in spark.createDataFrame([(v,) for v in values], "x double").select(significant("x", 24).alias("s")).collect()]
    for v, s in zip(values, got):
        assert s is None if v is None else abs(s - v) <= abs(v) * 2**-24


def test_larger_scale_keeps_the_order(spark):
    r = random.Random(3)
    rows = [(r.randint(0, 60), r.randint(0, 40), r.choice([1.0, 3.0])) for _ in range(1500)]
    p = RecParams(logistic_param=1.0, min_link_weight=0.5, prior=4.0, num_recs_per_item=10, initial_nhood_size=8)

    def ranks(prior, partitions):
        links, w = build_item_item_graph(spark.createDataFrame(rows, "user int, item int, weight double").repartition(partitions), 1.0, 0.5, 100)
        # popularity beyond any prior: the order of the links of an item must not change with it
        w = w.withColumn("overall_weight", F.lit(float(prior)))
        return {(x.item_A, x.item_B): x.rank for x in N.direct_neighbours(bayes_adjust(links, w, 0.0), 10).collect()}

    assert ranks(1.0, 1) == ranks(2.0**40, 3) == ranks(2.0**80, 7)
    assert p.prior == 4.0


def test_diversified_equals_its_uncapped_form(spark):
    r = random.Random(9)
    signals = spark.createDataFrame([(r.randint(0, 80), r.randint(0, 50), 1.0) for _ in range(2500)], "user int, item int, weight double")
    meta = spark.createDataFrame([(i, f"m{i % 3}") for i in range(51)], "item int, metadata_field string")
    p = RecParams(logistic_param=1.0, min_link_weight=0.5, prior=4.0, num_recs_per_item=20, initial_nhood_size=4)
    links, w = build_item_item_graph(signals, p.logistic_param, p.min_link_weight, p.max_links_per_user)
    full = N.two_hop_neighbours(diversify_links(bayes_adjust(links, w, p.prior), meta), p.initial_nhood_size, p.num_recs_per_item)
    assert sorted(map(tuple, R.item_item_recs_diversified(signals, meta, p).select("item_A", "item_B", "rank").collect())) \
        == sorted(map(tuple, full.select("item_A", "item_B", "rank").collect()))


def test_no_cap_and_large_k(spark):
    rows = spark.range(3000).select((F.col("id") % 1).alias("user"), F.col("id").alias("item"), (F.col("id") / 7).alias("weight"))
    assert G.top_links_per_user(rows, None).count() == 3000
    capped = top_k(rows, ["user"], [F.desc("weight")], 1500)
    assert capped.count() == 1500 and "WindowGroupLimit" in capped._jdf.queryExecution().executedPlan().toString()
    links = spark.createDataFrame([("a", "p", 2.0, 1.0), ("a", "q", 1.0, 1.0), ("p", "z", 1.0, 1.0)], LINKS)
    assert {r.item_B for r in N.two_hop_neighbours(links, None, 5).filter("item_A = 'a'").collect()} == {"p", "q", "z"}
