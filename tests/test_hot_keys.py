"""A key with a third of all rows is split over tasks in every join that meets it."""

import pytest
from pyspark.sql import functions as F

from cograph.functions.skew import salted_join
from cograph.operators import events as E
from cograph.operators import graph as G
from cograph.operators import inspect as X
from cograph.operators import neighbours as N
from cograph.operators import users as U

CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0"}
N_ROWS = 12_000


@pytest.fixture
def split(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)

    def check(df):
        """Runs ``df`` and tells whether adaptive execution split a join's hot partition."""
        plan = df.select(F.count(F.struct("*")))
        plan.collect()
        return "skew=true" in plan._jdf.queryExecution().executedPlan().toString()

    yield check
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, name, rest=500):
    """A column in which a third of the rows hold 7."""
    return F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % rest).cast("long").alias(name)


def rows(spark, *cols, n=N_ROWS):
    return spark.range(0, n, 1, 12).select(*cols)


def weights(spark, key="item"):
    """One row per key, out of an aggregate."""
    return rows(spark, (F.col("id") % 500).alias(key)).groupBy(key).agg(F.sum(F.lit(1.0)).alias("overall_weight"))


def links(spark):
    return rows(spark, F.col("id").alias("item_A"), hot(spark, "item_B"), (F.col("id") % 17 + 1.0).alias("weight"), F.lit(1.0).alias("raw_weight"))


def test_item_threshold(spark, split):
    ui = rows(spark, F.col("id").alias("user"), hot(spark, "item"), F.lit(1.0).alias("weight"))
    assert split(G.semi_join_items(ui, weights(spark)))


def test_popularity_join(spark, split):
    assert split(G.bayes_adjust(links(spark), weights(spark), 4.0))


def test_metadata_join(spark, split):
    meta = weights(spark).select("item", F.col("overall_weight").cast("string").alias("metadata_field"))
    j = G.links_with_metadata  # noqa: F841 - the diversity join has the same shape as the popularity join
    assert split(G.diversify_links(links(spark), meta, max_rank=3))


def test_first_hop(spark, split):
    more = rows(spark, (F.col("id") % 500).alias("item_A"), (F.col("id") * 31 % 500).alias("item_B"), (F.col("id") % 13 + 1.0).alias("weight"), F.lit(1.0).alias("raw_weight"), n=3000)
    assert split(N.two_hop_neighbours(links(spark).union(more), 3, 3))


def test_user_candidates(spark, split):
    recs = N.direct_neighbours(rows(spark, (F.col("id") % 500).alias("item_A"), (F.col("id") * 31 % 499).alias("item_B"), (F.col("id") % 13 + 1.0).alias("weight"), F.lit(1.0).alias("raw_weight"), n=3000), 3)
    signals = rows(spark, F.col("id").alias("user"), hot(spark, "item"), F.lit(1.0).alias("weight"))
    assert split(U.candidate_recs(signals, recs))


def test_bots(spark, split):
    signals = rows(spark, hot(spark, "user"), F.col("id").alias("item"), F.lit(1.0).alias("weight"))
    assert split(X.remove_bots(signals, 1000))


def test_fork_names(spark, split):
    parsed = rows(spark, F.col("id").cast("string").alias("item"), F.lit("t").alias("timestamp"), hot(spark, "repo_name").cast("string").alias("repo_name"),
                  (F.col("id") % 3 != 1).alias("is_a_fork"), (F.col("id") % 5).cast("int").alias("num_forks"), F.lit("l").alias("language"))
    assert split(E.fork_map(parsed))


def test_results_do_not_change(spark, split):
    got = {(r.item_A, r.item_B): r.weight for r in G.bayes_adjust(links(spark), weights(spark), 4.0).collect()}
    count = {i: sum(1 for x in range(N_ROWS) if x % 500 == i) for i in range(500)}
    assert got == {(i, b): (i % 17 + 1.0) / (count[b] + 4.0) for i in range(N_ROWS) for b in [7 if i % 3 == 0 else i % 500]}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hint", [None, "merge"])
def test_salted_join_is_the_plain_join(spark, how, hint):
    large = spark.createDataFrame([(k, i) for i in range(200) for k in ([7] if i % 3 == 0 else [i % 11, None])], "k int, v int")
    small = spark.createDataFrame([(k, str(k)) for k in range(3, 9)] + [(4, "again"), (None, "null")], "k int, w string")
    got = salted_join(large, small, "k", how, hint=hint)
    want = large.join(small, "k", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    """A stored table is read again and again after its shuffle is gone; a discarded one is gone itself."""
    import os

    from cograph.session import SHUFFLE_CLEANUP, discard, stored

    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    sums = spark.range(50_000).selectExpr("id % 997 as k", "id as v").groupBy("k").sum("v")
    table = stored(sums, "sums")
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    assert table.count() == table.count() == sums.count() == 997
    again = stored(table.join(sums.withColumnRenamed("sum(v)", "other"), "k"), "again")
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file:"))
    discard(table)
    assert not os.path.exists(folder) and again.count() == 997
    other = spark.range(3)
    other.write.parquet(str(tmp_path / "other"))
    discard(spark.read.parquet(str(tmp_path / "other")))  # no stored table: left alone
    assert spark.read.parquet(str(tmp_path / "other")).count() == 3
