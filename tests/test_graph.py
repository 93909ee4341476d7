import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cograph.operators import graph as G
from cograph.operators import neighbours as N
from cograph.params import RecParams
from cograph.plans.recommenders import item_item_recs_popularity_boost

L1, L3 = math.tanh(0.5), math.tanh(1.5)   # logistic_scale(1, 1), logistic_scale(3, 1)
SIG = "user string, item string, weight double"


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_build_item_item_graph_golden(spark):
    sig = spark.createDataFrame([
        ("u1", "a", 1.0), ("u1", "b", 1.0), ("u1", "c", 3.0),
        ("u2", "a", 2.0), ("u2", "a", 1.0), ("u2", "b", 1.0),
        (None, "a", 5.0), ("u3", None, 5.0)], SIG)
    links, weights = G.build_item_item_graph(sig, 1.0, 0.5, 10)
    w = {r.item: r.overall_weight for r in weights.collect()}
    assert w == pytest.approx({"a": L1 + L3, "b": 2 * L1, "c": L3})
    got = {(r.item_A, r.item_B): r.weight for r in links.collect()}
    # (a,b): u1 gives min(L1, L1), u2 gives min(L3, L1); (a,c) and (b,c) only reach L1 = 0.462 < 0.5
    assert set(got) == {("a", "b"), ("b", "a")}
    assert got[("a", "b")] == pytest.approx(2 * L1)
    assert got[("b", "a")] == got[("a", "b")]


def test_item_threshold_before_pairing_and_top_k(spark):
    # c is below the item threshold, so it cannot take u1's only top-1 slot
    sig = spark.createDataFrame([("u1", "a", 1.0), ("u1", "c", 3.0), ("u2", "a", 1.0), ("u3", "a", 1.0)], SIG)
    ui, _ = G.filtered_user_items(sig, 1.0, 1.0)
    assert _rows(ui, "user", "item") == [("u1", "a"), ("u2", "a"), ("u3", "a")]
    top = G.top_links_per_user(G.aggregate_signals(sig, 1.0), 1, "rank")
    assert _rows(top.filter("user = 'u1'"), "item", "rank") == [("c", 1)]


def test_links_are_symmetric_before_adjustment(spark):
    from cograph.sources.testdata import signals_fx1
    links, _ = G.build_item_item_graph(signals_fx1(spark, "/root/testdata/sf0.001"), 1.0, 1.0, 100)
    a = links.select("item_A", "item_B", F.round("weight", 9).alias("w"))
    b = links.select(F.col("item_B").alias("item_A"), F.col("item_A").alias("item_B"), F.round("weight", 9).alias("w"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bayes_and_boost(spark):
    links = spark.createDataFrame([("a", "b", 2.0)], "item_A string, item_B string, weight double")
    weights = spark.createDataFrame([("b", 4.0)], "item string, overall_weight double")
    r = G.bayes_adjust(links, weights, 4.0).first()
    assert (r.weight, r.raw_weight) == (0.25, 2.0)
    assert G.boost_adjust(links, weights, 4.0, "SQRT").first().weight == pytest.approx(2.0 * 2.0 / 8.0)
    assert G.boost_adjust(links, weights, 4.0, "").first().weight == pytest.approx(1.0)


def test_add_item_item_signals_both_modes(spark):
    links = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "item_A string, item_B string, weight double")
    weights = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "item string, overall_weight double")
    extra = spark.createDataFrame([("a", "b", 0.5), ("b", "c", -3.0), ("c", "a", 1.0)],
                                  "item_A string, item_B string, weight double")
    l0, w0 = G.add_item_item_signals(links, extra, weights, "zero")
    assert dict(_rows(w0, "item", "overall_weight")) == {"a": 2.5, "b": 0.0, "c": 1.0}
    # union without merging equal pairs; only weight > 0
    assert _rows(l0, "item_A", "item_B", "weight") == [("a", "b", 0.5), ("a", "b", 1.0), ("b", "a", 1.0),
                                                        ("c", "a", 1.0)]
    _, wn = G.add_item_item_signals(links, extra, weights, "null")
    assert dict(_rows(wn, "item", "overall_weight")) == {"a": 2.5, "b": 0.0, "c": None}


def test_diversify_and_owner_diversity(spark):
    links = spark.createDataFrame([("a", "b", 0.9, 1.0), ("a", "c", 0.8, 1.0), ("a", "d", 0.4, 1.0)],
                                  "item_A string, item_B string, weight double, raw_weight double")
    meta = spark.createDataFrame([("b", "x"), ("c", "x"), ("d", "y")], "item string, metadata_field string")
    got = dict((r.item_B, r.weight) for r in G.diversify_links(links, meta).collect())
    assert got == pytest.approx({"b": 0.9, "c": 0.4, "d": 0.4})
    recs = spark.createDataFrame([("a", "o1/x", 0.9, 1.0), ("a", "o1/y", 0.8, 1.0), ("a", "o2/z", 0.5, 1.0)],
                                 "item_A string, item_B string, weight double, raw_weight double")
    out = _rows(G.owner_diversity(recs), "rank", "item_B", "weight")
    assert out == [(1, "o1/x", 0.9), (2, "o2/z", 0.5), (3, "o1/y", 0.4)]


def _links(spark, rows):
    return spark.createDataFrame([(a, b, w, w) for a, b, w in rows],
                                 "item_A string, item_B string, weight double, raw_weight double")


def test_two_hop_golden(spark):
    # a->b (dist 1), b->c (dist 1), a->c (dist 4), a->e (dist 2), b->e (dist 1)
    links = _links(spark, [("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 0.25), ("a", "e", 0.5), ("b", "e", 1.0)])
    recs = N.two_hop_neighbours(links, 3, 10)
    got = {(r.item_A, r.item_B): (r.weight, r.raw_weight, r.rank) for r in recs.collect()}
    # a keeps b, e (dist 2) and... c (dist 4) survives nhood 3; the path a->b->c (dist 2) beats it
    assert got[("a", "b")] == (1.0, 1.0, 1)
    assert got[("a", "c")] == (0.5, None, 2)          # indirect: raw_weight null
    assert got[("a", "e")] == (0.5, 0.5, 3)           # tie direct (2) vs a->b->e (2): direct wins
    assert got[("b", "c")][2] == 1 and got[("b", "e")][2] == 2
    assert ("a", "a") not in got


def test_two_hop_with_full_neighbourhood_never_ranks_worse_than_direct(spark):
    from cograph.sources.testdata import signals_fx1
    links, w = G.build_item_item_graph(signals_fx1(spark, "/root/testdata/sf0.001"), 1.0, 1.0, 100)
    adj = G.bayes_adjust(links, w, 4.0)
    direct = N.direct_neighbours(adj, 5).select("item_A", "item_B", F.col("weight").alias("dw"))
    two = N.two_hop_neighbours(adj, 1000, 5).select("item_A", F.col("weight").alias("tw"), "rank")
    # the k-th best weight with two-hop paths is at least the k-th best direct weight
    d_rank = N.direct_neighbours(adj, 5).select("item_A", "rank", F.col("weight").alias("dw"))
    bad = d_rank.join(two, ["item_A", "rank"]).filter(F.col("tw") < F.col("dw") - 1e-12).count()
    assert bad == 0 and direct.count() > 0


def test_ranks_have_no_gaps(spark):
    from cograph.sources.testdata import signals_fx1
    from cograph.plans.recommenders import item_item_recs
    from cograph.params import RecParams
    recs = item_item_recs(signals_fx1(spark, "/root/testdata/sf0.001"),
                          RecParams(logistic_param=1.0, min_link_weight=1.0))
    s = recs.groupBy("item_A").agg(F.count("*").alias("n"), F.max("rank").alias("m"),
                                   F.countDistinct("rank").alias("d"))
    assert s.filter((F.col("n") != F.col("m")) | (F.col("n") != F.col("d"))).count() == 0


def test_available_items_restrict_ends_not_middle(spark):
    links = _links(spark, [("a", "m", 1.0), ("m", "b", 1.0), ("a", "x", 0.9)])
    src = spark.createDataFrame([("a",), ("a",)], "item string")
    dst = spark.createDataFrame([("b",)], "item string")
    out = _rows(N.available_neighbours(links, src, dst, 5, 10), "item_A", "item_B", "raw_weight", "rank")
    assert out == [("a", "b", None, 1)]


def test_direct_neighbours(spark):
    links = _links(spark, [("a", "b", 0.5), ("a", "c", 0.5), ("a", "d", 0.9)])
    assert _rows(N.direct_neighbours(links, 2), "item_B", "rank") == [("b", 2), ("d", 1)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], SIG)
    links, weights = G.build_item_item_graph(empty, 1.0, 1.0, 10)
    assert links.count() == 0 and weights.count() == 0


def test_log_boost_non_positive_weights_are_dropped_by_two_hop(spark):
    # popularity 0.5 < 1 -> ln < 0 -> negative adjusted weight, no finite distance
    links = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 1.0)], "item_A string, item_B string, weight double")
    weights = spark.createDataFrame([("b", 0.5), ("c", 3.0)], "item string, overall_weight double")
    adj = G.boost_adjust(links, weights, 1.0, "LOG")
    assert dict((r.item_B, r.weight < 0) for r in adj.collect()) == {"b": True, "c": False}
    recs = N.two_hop_neighbours(adj, 5, 5).collect()
    assert [(r.item_A, r.item_B) for r in recs] == [("a", "c")]


def test_add_item_item_recommender_null_mode_keeps_complete_rows(spark):
    from cograph.params import RecParams
    from cograph.plans.recommenders import item_item_recs_add_item_item
    sig = spark.createDataFrame([("u1", "a", 1.0), ("u1", "b", 1.0), ("u2", "a", 1.0), ("u2", "b", 1.0)],
                                "user string, item string, weight double")
    extra = spark.createDataFrame([("a", "z", 2.0)], "item_A string, item_B string, weight double")
    p = RecParams(logistic_param=1.0, min_link_weight=0.5, prior=1.0)
    for mode in ("zero", "null"):
        out = item_item_recs_add_item_item(sig, extra, p, missing=mode).collect()
        assert out and all(r.raw_weight is not None and r.weight is not None for r in out)
    # z is never an item_A of the extra links, so it has no combined popularity in either mode
    # and the popularity join drops links to it
    null_targets = {r.item_B for r in item_item_recs_add_item_item(sig, extra, p, missing="null").collect()}
    zero_targets = {r.item_B for r in item_item_recs_add_item_item(sig, extra, p, missing="zero").collect()}
    assert "z" not in null_targets and "z" not in zero_targets


def test_pairs_of_a_task_are_bounded(spark, monkeypatch):
    """More pairs, more tasks, whatever the number of shuffle partitions; the links stay the same."""
    rows = [(u, (u * 7 + i * i) % 40, float(1 + (u + i) % 3)) for u in range(60) for i in range(12)]
    sig = spark.createDataFrame(rows, "user int, item int, weight double")
    links = lambda: sorted((r.item_A, r.item_B, round(r.weight, 9)) for r in G.build_item_item_graph(sig, 1.0, 1.0, 10)[0].collect())
    before, want = spark.conf.get(G.PARTITIONS_CONF, None), links()
    ui = G.aggregate_signals(sig, 1.0)
    pairs = sum(min(n, 10) * (min(n, 10) - 1) // 2 for n in Counter(r.user for r in ui.collect()).values())
    monkeypatch.setattr(G, "TASK_PAIRS", 100)
    try:
        tasks = -(-pairs // 100)
        assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert G.dealt_by_pairs(ui, 10).rdd.getNumPartitions() == tasks == int(spark.conf.get(G.PARTITIONS_CONF))
        assert links() == want != []
    finally:
        spark.conf.unset(G.PARTITIONS_CONF) if before is None else spark.conf.set(G.PARTITIONS_CONF, before)


@pytest.mark.parametrize("boost", ["SQRT", "LOG", ""])
def test_a_neighbourhood_as_large_as_the_list_bounds_the_paths(spark, boost):
    """The recs of the unbounded search, and a bound in the plan."""
    rows = [(u, (u * 7 + i * i) % 40, float(1 + (u + i) % 3)) for u in range(60) for i in range(12)]
    sig = spark.createDataFrame(rows, "user int, item int, weight double")
    p = RecParams(logistic_param=1.0, min_link_weight=1.0, prior=4.0, num_recs_per_item=5, initial_nhood_size=5)
    got = item_item_recs_popularity_boost(sig, p, boost)
    links, weights = G.build_item_item_graph(sig, 1.0, 1.0, p.max_links_per_user)
    want = N.two_hop_neighbours(G.boost_adjust(links, weights, 4.0, boost), 5, 5)
    rows_of = lambda df: sorted((r.item_A, r.rank, r.item_B, round(r.weight, 9), r.raw_weight is None) for r in df.collect())
    assert "bound" in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(got) == rows_of(want) != []
