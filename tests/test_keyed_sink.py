"""Puts through the committing sink: all or nothing, last write wins, repeated writes change nothing."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cograph.sources import keyed_sink as KS

SPEC = "user string, rank int, rec string, score double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SPEC).repartition(3)


def table(spark, path):
    return sorted(map(tuple, KS.read_rows(spark, path, frame(spark, []).schema).collect()), key=str)


def put(spark, path, rows, **kw):
    KS.put_rows(frame(spark, rows), path, "user", "rank", **{"buckets": 4} | kw)


def rows_for(seed, n=60):
    r = random.Random(seed)
    keys = {(r.choice(["hot", "hot", "a\nb", "é漢", "", "x"]), r.randrange(40)) for _ in range(n)}
    return [(u, k, r.choice([None, "rec", 'q"uote']), r.random()) for u, k in sorted(keys)]


def test_puts_are_merged_by_key(spark, tmp_path):
    path, want = str(tmp_path / "t"), {}
    assert table(spark, path) == []
    for seed in range(3):
        rows = rows_for(seed)
        put(spark, path, rows)
        want |= {(u, k): (u, k, rec, s) for u, k, rec, s in rows}
        assert table(spark, path) == sorted(want.values(), key=str)


def test_the_same_rows_again_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, rows_for(1))
    put(spark, path, rows_for(2))
    state = {f: os.stat(f"{path}/{d}/{f}").st_size for d in ("rows", "commits") for f in os.listdir(f"{path}/{d}")}
    put(spark, path, rows_for(2))
    put(spark, path, [])
    assert state == {f: os.stat(f"{path}/{d}/{f}").st_size for d in ("rows", "commits") for f in os.listdir(f"{path}/{d}")}
    assert KS.Folder(path).generations() == [1, 2]


def test_a_failed_task_leaves_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, rows_for(1))
    before = table(spark, path)
    with pytest.raises(Exception, match="a key is null"):
        put(spark, path, rows_for(5) + [(None, 1, "x", 0.0)])
    bad = frame(spark, rows_for(6)).withColumn("rec", F.when(F.col("rank") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("rec")))
    with pytest.raises(Exception, match="lost"):
        KS.put_rows(bad, path, "user", "rank", 4)
    assert table(spark, path) == before and KS.Folder(path).generations() == [1]


def test_aborted_tasks_are_cleared_and_second_writers_refused(tmp_path):
    options = {"path": str(tmp_path / "t"), "buckets": "2", "keys": '["user"]'}
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("user", StringType()), StructField("rec", StringType()), StructField(KS.BUCKET, IntegerType())])
    row = lambda b, u, rec: {"user": u, "rec": rec, KS.BUCKET: b}
    one, two = KS.KeyedWriter(options, schema), KS.KeyedWriter(options, schema)
    m = one.write(iter([row(0, "a", "1"), row(0, "a", "2"), row(1, "b", "3")]))
    aborted = two.write(iter([row(1, "z", "9")]))
    assert KS.Folder(options["path"]).current() == (0, {})  # nothing shows yet
    one.commit([m, None])
    two.abort([aborted, None])
    n, files = KS.Folder(options["path"]).current()
    assert n == 1 and [list(KS.Folder(options["path"]).lines(files[b])) for b in (0, 1)] == [['{"user": "a", "rec": "2"}'], ['{"user": "b", "rec": "3"}']]
    assert sorted(os.listdir(tmp_path / "t" / "rows")) == sorted(f.split("/")[1] for f in files.values())
    late = two.write(iter([row(1, "z", "9")]))
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit([late])
