"""User recs of many signals, made in rounds, and item keys that a driver would have to hold."""

import random

import pytest
from pyspark.sql import functions as F

from cograph.operators import neighbours as N
from cograph.operators import users as U


def shown(recs):
    return sorted(map(str, recs.collect()))


@pytest.mark.parametrize("by,diverse,task", [([], False, 1 << 19), ([], True, 60), (["channel"], False, 60)])
def test_rounds_give_the_same_recs(spark, monkeypatch, by, diverse, task):
    """Repeated, seen and null rows, weights that tie, users with very many candidates included."""
    r = random.Random(3)
    rows = [(u, i, r.choice([1.0, 2.0, None]), r.choice([1, 2])) for u in range(40) for i in r.sample(range(30), r.randint(1, 5) if u else 25) for _ in range(2)]
    sig = spark.createDataFrame([*rows, (None, 1, 1.0, 1), (1, None, 1.0, 1)], "user int, item int, weight double, channel int")
    recs = spark.createDataFrame([(a, b, r.choice([0.5, 1.0, r.random()]), r.choice([1.0, None])) for a in range(28) for b in r.sample(range(40), r.randint(0, 6))],
                                 "item_A int, item_B int, weight double, raw_weight double")
    want = shown(U.build_user_recs(sig, recs, 4, diverse, by))
    written = []
    real = U.stored_in_parts
    monkeypatch.setattr(U, "stored_in_parts", lambda parts, name: real((written.append(name) or p for p in parts), name))
    monkeypatch.setattr(U, "FEW_SIGNALS", 0)
    monkeypatch.setattr(U, "ROUND_CANDIDATES", 300)
    monkeypatch.setattr(U, "TASK_CANDIDATES", task)
    assert shown(U.build_user_recs(sig, recs, 4, diverse, by)) == want != []
    assert len(written) >= 3


def test_item_keys_are_not_sent_by_the_size_of_their_file(spark, tmp_path):
    """100,000 keys are a small file; what counts is how many the driver would hold."""
    path = str(tmp_path / "items")
    wide = spark.range(100_000).select(F.col("id").alias("item"), *(F.lit("a").alias(f"c{i}") for i in range(20)))
    wide.coalesce(1).write.parquet(path)
    links = spark.createDataFrame([(a, b, 1.0 + a, 1.0) for a in range(9) for b in range(9)], "item_A long, item_B long, weight double, raw_weight double")
    old = {c: spark.conf.get(c, None) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}

    def plan(n, limit):
        for c in old:
            spark.conf.set(c, limit)
        keys = spark.read.parquet(path).select("item").filter(F.col("item") < n)
        found = N.available_neighbours(links, keys, keys, 4, 5)
        return found.count(), found._jdf.queryExecution().optimizedPlan().toString().count("strategy=merge")

    try:
        few, many = plan(100, "1MB"), plan(100_000, "1MB")
        assert few[0] == many[0] > 0 and (few[1], many[1]) == (0, 2)
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
