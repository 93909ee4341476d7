"""Results do not depend on the number of shuffle partitions or on input order."""

from pyspark.sql import functions as F

from cograph.operators import graph as G
from cograph.params import RecParams
from cograph.plans import recommenders as R
from cograph.sources.testdata import signals_fx1

P = RecParams(logistic_param=1.0, min_link_weight=1.0, prior=4.0, initial_nhood_size=5, num_recs_per_user=5)


def _recs(spark, partitions, shuffled):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        sig = signals_fx1(spark, "/root/testdata/sf0.001")
        if shuffled:
            sig = sig.repartition(7).orderBy(F.rand(seed=3))
        item = R.item_item_recs(sig, P)
        user = R.user_item_recs(sig, item, P.with_(diversity_adjust=True))
        return (sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in item.collect()),
                sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in user.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_independent_of_partitions_and_order(spark):
    a = _recs(spark, 3, False)
    b = _recs(spark, 11, True)
    assert len(a[0]) > 0 and len(a[1]) > 0
    assert a == b


def test_duplicate_metadata_multiplies_links(spark):
    links = spark.createDataFrame([("a", "b", 0.5, 1.0)],
                                  "item_A string, item_B string, weight double, raw_weight double")
    meta = spark.createDataFrame([("b", "x"), ("b", "y")], "item string, metadata_field string")
    assert G.diversify_links(links, meta).count() == 2
    assert G.links_with_metadata(links.drop("raw_weight"), meta).count() == 0   # a has no metadata


def test_no_rec_in_seen_set_and_indirect_iff_null_raw_weight(spark):
    sig = signals_fx1(spark, "/root/testdata/sf0.001")
    item = R.item_item_recs(sig, P)
    user = R.user_item_recs(sig, item, P)
    assert user.join(sig, ["user", "item"], "left_semi").count() == 0
    from cograph.sources.testdata import typed_signals_fx2
    det = R.item_item_recs_detailed(typed_signals_fx2(spark, "/root/testdata/sf0.01"), P.with_(min_link_weight=15.0))
    bad = det.filter(F.col("raw_weight").isNull() != F.col("linking_item").isNotNull()).count()
    assert det.count() > 0 and bad == 0
    assert det.filter(F.col("raw_weight").isNull() != F.col("link_data").isNull()).count() == 0


def test_one_item_users_form_no_links(spark):
    sig = spark.createDataFrame([("u1", "a", 3.0), ("u2", "b", 3.0), ("u3", "a", 3.0)],
                                "user string, item string, weight double")
    links, weights = G.build_item_item_graph(sig, 1.0, 0.1, 10)
    assert links.count() == 0 and weights.count() == 2
