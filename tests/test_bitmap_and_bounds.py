"""Rows that are dropped before an exchange never change a result."""

import random

import pytest
from pyspark.sql import functions as F

from cograph.functions import bitmap as B
from cograph.operators import detailed as D
from cograph.operators import graph as G
from cograph.operators import neighbours as N
from cograph.plans import recommenders as R
from cograph.params import RecParams


@pytest.fixture
def no_broadcast(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_prefilter_keeps_every_match_and_drops_most_others(spark, no_broadcast):
    rows = spark.range(0, 20_000).select((F.col("id") % 5000).alias("a"), F.concat(F.lit("k"), F.col("id") % 7).alias("b"), "id")
    keys = rows.filter("a % 20 = 3 and b <> 'k4'").select(F.col("a").alias("x"), F.col("b").alias("y")).distinct()
    kept = B.prefilter(rows, keys, ["a", "b"], ["x", "y"])
    assert kept.columns == rows.columns
    exact = rows.join(keys, (rows["a"] == keys["x"]) & (rows["b"] == keys["y"]), "left_semi")
    n, want, got = rows.count(), exact.count(), kept.count()
    assert want <= got < want + 0.12 * n  # one bit in sixteen is set
    assert rows_of(kept.join(keys, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_semi")) == rows_of(exact)
    assert B.prefilter(rows, keys.limit(0), ["a", "b"], ["x", "y"]).count() == 0
    narrow = keys.select(F.col("x").cast("int").alias("x"), "y")
    assert rows_of(B.prefilter(rows, narrow, ["a", "b"], ["x", "y"])) == rows_of(kept)
    assert B.prefilter(rows, keys.select(F.col("x").cast("string")), ["a"], ["x"]) is rows


def test_prefilter_leaves_small_and_huge_key_sets_alone(spark, monkeypatch, no_broadcast):
    rows, keys = spark.range(10).toDF("a"), spark.range(5).toDF("a")
    monkeypatch.setattr(B, "MOST_WORDS", 1)
    assert B.prefilter(rows, keys, ["a"]) is rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    monkeypatch.setattr(B, "MOST_WORDS", 1 << 20)
    assert B.prefilter(rows, keys, ["a"]) is rows
    assert [B._bytes(x) for x in ("10MB", "256k", "1024", "-1", "2g", "10485760b")] == [10 << 20, 256 << 10, 1024, -1, 2 << 30, 10 << 20]


def _typed(spark):
    r = random.Random(2)
    return spark.createDataFrame([(u, r.randrange(120), r.choice(["buy", "view", None]), r.choice([1.0, 3.0])) for u in range(80) for _ in range(20)],
                                 "user int, item int, signal_type string, weight double")


def test_detailed_links_do_not_depend_on_the_bitmap(spark, monkeypatch, no_broadcast):
    sig = _typed(spark)
    seen = []
    real = D.prefilter

    def counted(rows, keys, columns):
        out = real(rows, keys, columns)
        seen.append((rows.count(), out.count()))
        return out

    monkeypatch.setattr(D, "prefilter", counted)
    links = lambda: rows_of(D.link_data_long(D.build_item_item_graph_detailed(sig, 1.0, 3.4, 100)[0]))
    with_bitmap = links()
    assert seen and 0 < seen[0][1] < seen[0][0] / 2  # fewer rows are shuffled
    monkeypatch.setattr(D, "prefilter", lambda rows, keys, columns: rows)
    assert with_bitmap == links() and with_bitmap


def test_available_items_do_not_depend_on_the_bitmap(spark, monkeypatch, no_broadcast):
    links = _links(spark, 7)
    src, dst = spark.range(0, 40).toDF("item"), spark.range(0, 60, 7).toDF("item")
    run = lambda: rows_of(N.available_neighbours(links, src, dst, 8, 5))
    with_bitmap = run()
    monkeypatch.setattr(N, "prefilter", lambda rows, *_: rows)
    assert with_bitmap == run() and with_bitmap


def _links(spark, seed, itself=True):
    r = random.Random(seed)
    pairs = {(a, b) for a in range(60) for b in r.sample(range(60), r.randint(1, 30)) if itself or a != b}
    return spark.createDataFrame([(a, b, r.choice([0.25, 0.5, 1.0, r.random()]), 1.0) for a, b in pairs], "item_A int, item_B int, weight double, raw_weight double")


@pytest.mark.parametrize("nhood,recs", [(None, 3), (25, 4), (10, 10), (3, 8)])
def test_bounded_expansion_gives_the_same_recommendations(spark, nhood, recs):
    """Ties at the bound and links of an item to itself included."""
    links = _links(spark, recs)
    assert rows_of(N.two_hop_neighbours(links, nhood, recs, bounded=True)) == rows_of(N.two_hop_neighbours(links, nhood, recs))
    carried = links.withColumn("note", F.concat("item_A", F.lit("-"), "item_B"))
    assert rows_of(N.two_hop_neighbours(carried, nhood, recs, ["note"], True, bounded=True)) == rows_of(N.two_hop_neighbours(carried, nhood, recs, ["note"], True))


@pytest.mark.parametrize("nhood,recs", [(None, 3), (25, 4), (10, 10)])
def test_bounded_expansion_with_repeated_links(spark, nhood, recs):
    """Links that occur several times, to the item itself too, count once for the bound."""
    links = _links(spark, recs)
    links = links.unionByName(links.filter("item_B % 3 = 0")).unionByName(links.filter("item_B % 2 = 0").withColumn("weight", F.col("weight") * 0.75))
    search = lambda **kw: rows_of(N.two_hop_neighbours(links, nhood, recs, **kw).distinct())
    assert search(bounded=True, repeats=True) == search()


def test_added_links_are_searched_within_the_bound(spark):
    sig = spark.createDataFrame([(u, i, 1.0) for u in range(30) for i in range(u % 7, 40, 3)], "user int, item int, weight double")
    extra = spark.createDataFrame([(i, (i * 7 + 3) % 40, 2.0) for i in range(40)] * 2, "item_A int, item_B int, weight double")
    p = RecParams(min_link_weight=0.1, initial_nhood_size=5, num_recs_per_item=4)
    found = R.item_item_recs_add_item_item(sig, extra, p)
    assert "AS bound#" in found._jdf.queryExecution().analyzed().toString()
    links, w = G.add_item_item_signals(G.build_item_item_graph(sig, p.logistic_param, p.min_link_weight, p.max_links_per_user)[0], extra,
                                       G.build_item_item_graph(sig, p.logistic_param, p.min_link_weight, p.max_links_per_user)[1])
    want = N.two_hop_neighbours(G.bayes_adjust(links, w, p.prior), 5, 4).dropna()
    shown = lambda df: [(r.item_A, r.item_B, round(r.weight, 9), r.rank) for r in df.orderBy("item_A", "rank").collect()]
    assert shown(found) == shown(want) != []


def test_bounded_expansion_makes_fewer_candidates(spark):
    counts = {r.bounded: r.rows for r in N.candidate_rows(_links(spark, 1, False), None, 3).collect()}
    assert 0 < counts[True] < counts[False] / 3


def test_wide_neighbourhoods_are_bounded(spark):
    sig = spark.createDataFrame([(u, i, 1.0) for u in range(30) for i in range(u % 7, 40, 3)], "user int, item int, weight double")
    p = RecParams(min_link_weight=0.1, initial_nhood_size=None, num_recs_per_item=4)
    assert "AS bound#" in R.item_item_recs(sig, p)._jdf.queryExecution().analyzed().toString()
    assert "AS bound#" not in R.item_item_recs(sig, p.with_(initial_nhood_size=4))._jdf.queryExecution().analyzed().toString()
