"""Streaming deduplication against grouping by the whole text."""

import random
from hashlib import sha256

import pytest
from llm_cases import corpus

from cograph.llm import stream_dedup
from cograph.llm.stream_dedup import Source

SCHEMA = "doc_id long, text string, file string, row string, keep string, n string, digest string, _metadata string"


def write(spark, folder, rows, files=3, mode="append"):
    df = spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], SCHEMA).repartition(files)
    df.write.mode(mode).parquet(folder)


def by_hand(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        out += [(i, ids[0], len(ids), at == 0, sha256(t.encode()).hexdigest()) for at, i in enumerate(ids)]
    return sorted(out, key=str)


def run(spark, path, folder, **more):
    options = {k: more.pop(k) for k in list(more) if k == "batch_bytes"}
    got = stream_dedup.exact_duplicates(spark, Source(path, **more), folder, **options)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, got.collect()), key=str)


def many(seed, n=400):
    r = random.Random(seed)
    return [(r.choice([None, *range(300)]), r.choice([None, "", "hot", "hot", "hot", "A", "a", "a ", "é", "x" * 200_000, f"only {i}"])) for i in range(n)]


def test_every_case(spark, tmp_path):
    rows = corpus() + many(1)
    write(spark, f"{tmp_path}/t", rows, 7)
    got = run(spark, f"{tmp_path}/t", f"{tmp_path}/state")
    assert got == by_hand(rows)
    assert sum(x[3] for x in got) == len({t or "" for _, t in rows})


@pytest.mark.parametrize("digest_bytes", [0, 1])
def test_equal_digests_of_different_texts(spark, tmp_path, digest_bytes):
    """A hit is only a copy if all bytes are equal."""
    rows = many(2) + [(i, f"text {i % 40}") for i in range(200)]
    write(spark, f"{tmp_path}/t", rows)
    assert run(spark, f"{tmp_path}/t", f"{tmp_path}/state", digest_bytes=digest_bytes) == by_hand(rows)


def test_state_is_carried_over_batches_and_runs(spark, tmp_path):
    """One file a batch; later runs read new files only and know all earlier texts."""
    path, folder = f"{tmp_path}/t", f"{tmp_path}/state"
    rows = []
    for day in range(3):
        new = many(10 + day, 100)
        write(spark, path, new, 3)
        rows += new
        state = stream_dedup.absorb(Source(path), spark, folder, batch_bytes=1)
        assert {r.digest.hex(): r.n for r in state.collect()} == {x[4]: x[2] for x in by_hand(rows)}
        last = spark.read.format("state-metadata").load(folder).agg({"maxBatchId": "max"}).first()[0]
        assert last == 3 * (day + 1) - 1  # every file was read once
    assert run(spark, path, folder) == by_hand(rows)


def test_settings_are_left_as_they_were(spark, tmp_path):
    before = [spark.conf.get(c, None) for c in stream_dedup.STATE_CONF]
    write(spark, f"{tmp_path}/t", [(1, "a")], 1)
    assert run(spark, f"{tmp_path}/t", f"{tmp_path}/state") == by_hand([(1, "a")])
    assert [spark.conf.get(c, None) for c in stream_dedup.STATE_CONF] == before


def test_a_single_file_and_no_rows(spark, tmp_path):
    write(spark, f"{tmp_path}/t", many(5, 30), 1)
    file = next((tmp_path / "t").glob("part-*"))
    assert run(spark, str(file), f"{tmp_path}/state") == by_hand(many(5, 30))
    write(spark, f"{tmp_path}/empty", [], 1)
    assert run(spark, f"{tmp_path}/empty", f"{tmp_path}/state2") == []


def test_no_python_and_split_hits(spark, tmp_path):
    write(spark, f"{tmp_path}/t", many(6))
    source = Source(f"{tmp_path}/t")
    plan = stream_dedup.resolve(source.rows(spark), stream_dedup.absorb(source, spark, f"{tmp_path}/state"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
