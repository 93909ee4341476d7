"""WARC: exact round trip, deterministic files, revisits."""

import base64
import gzip
import hashlib
import os

import numpy as np
import pytest

from cograph.llm import warc

SPEC = "page_id long, url string, html string, record_type string"
PAGES = [(5, "http://a/x", "<p>ü</p>", "clash"), (1, "http://b/", "<p>same</p>", "clash"), (9, None, "<p>same</p>", "clash"), (3, "http://c/\r\ninjected: x", "<p>same</p>", "clash"),
         (2, "", None, "clash"), (4, "http://e/", "", "clash"), (None, "http://n/", "<p>same</p>", "clash"), (7, "http://f/", "x" * 300_000, "clash"),
         (8, "http://g/", "\r\n\r\nWARC/1.1\r\n\r\n", "clash"), (8, "http://g/", "\r\n\r\nWARC/1.1\r\n\r\n", "clash"), (-4, "http://h/", "y", "clash")]


def expected(pages):
    last = {}
    for page, _, html, _ in pages:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    for page, _, html, _ in pages:
        raw = (html or "").encode()
        revisit = page is not None and last[html or ""] != page
        yield (page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", last[html or ""] if revisit else None, None if revisit else raw)


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("writer", [warc.Writer(), warc.Writer(roll_bytes=700, shard_bytes=1500)])
def test_round_trip(spark, tmp_path, writer):
    pages = spark.createDataFrame(PAGES, SPEC).repartition(3)
    manifest = warc.write_archive(pages, f"{tmp_path}/w", writer)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in warc.read_archive(manifest, f"{tmp_path}/w").collect()]
    assert sorted(got, key=key) == sorted(expected(PAGES), key=key)
    files = {x for x in os.listdir(f"{tmp_path}/w") if not x.endswith(".crc")}
    rows = manifest.collect()
    assert files == {r.name for r in rows} | {"manifest"} and len(rows) == (1 if writer == warc.Writer() else len(rows)) and sum(r.records for r in rows) == len(PAGES)
    for r in rows:
        with open(f"{tmp_path}/w/{r.name}", "rb") as f:
            data = f.read()
        assert len(data) == r.bytes and hashlib.sha1(data).hexdigest() == r.sha1 and gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        assert r.records == 1 or r.bytes <= writer.roll_bytes


def test_files_do_not_depend_on_the_input_order(spark, tmp_path):
    w = warc.Writer(roll_bytes=700, shard_bytes=1500)
    a = warc.write_archive(spark.createDataFrame(PAGES, SPEC).repartition(4), f"{tmp_path}/a", w).collect()
    b = warc.write_archive(spark.createDataFrame(PAGES[::-1], SPEC).coalesce(1), f"{tmp_path}/b", w).collect()
    assert sorted(a) == sorted(b)


def test_files_outside_the_manifest_do_not_count_and_damage_is_found(spark, tmp_path):
    folder = f"{tmp_path}/w"
    manifest = warc.write_archive(spark.createDataFrame(PAGES[:2], SPEC), folder)
    with open(f"{folder}/pages-000009-00000.warc.gz", "wb") as f:
        f.write(b"left over")
    assert warc.read_archive(manifest, folder).count() == 2
    name = manifest.first().name
    with open(f"{folder}/{name}", "r+b") as f:
        f.truncate(50)
    if os.path.exists(f"{folder}/.{name}.crc"):
        os.remove(f"{folder}/.{name}.crc")
    with pytest.raises(Exception, match="is not the file of the manifest"):
        warc.read_archive(manifest, folder).collect()


def test_small_payloads_can_be_left_alone(spark, tmp_path):
    w = warc.Writer(least_revisit=12)
    rows = warc.read_archive(warc.write_archive(spark.createDataFrame(PAGES, SPEC), f"{tmp_path}/w", w), f"{tmp_path}/w").collect()
    assert all(r.record_type == "response" for r in rows)


@pytest.mark.parametrize("far", [None, 10**15])
def test_shards_hold_equal_bytes_whatever_the_ids(spark, tmp_path, far):
    """One id far out, a third of the rows without id, a third equal rows."""
    w = warc.Writer(shard_bytes=20_000)
    rows = [(i, f"http://{i}", f"<p>{i * i} {'z' * 900}</p>", "x") for i in range(300)] + [(None, f"http://n{i}", f"{i}{'n' * 900}", "x") for i in range(300)]
    rows += [(77, "http://same", "s" * 900, "x")] * 300 + ([(far, "http://far", "far", "x")] if far else [])
    manifest = warc.write_archive(spark.createDataFrame(rows, SPEC).repartition(5), f"{tmp_path}/w", w)
    sizes = [r.n for r in manifest.groupBy("shard").agg({"records": "sum"}).toDF("shard", "n").collect()]
    assert len(sizes) >= 60 and max(sizes) <= 40 and sum(sizes) == len(rows)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in warc.read_archive(manifest, f"{tmp_path}/w").collect()]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


def test_shard_of_a_place():
    cuts = np.array([(1, 5, 5), (1, 5, 9), (1, 7, 0), (4, 0, 0), (4, 0, 0)], np.int64)
    places = np.array([(0, 9, 9), (1, 5, 4), (1, 5, 5), (1, 5, 8), (1, 5, 9), (1, 6, 99), (1, 7, 0), (3, 0, 0), (4, -1, 0), (4, 0, 0), (9, 9, 9)], np.int64)
    want = [sum(tuple(c) <= tuple(x) for c in cuts.tolist()) for x in places.tolist()]
    assert warc.shards_of(cuts, places).tolist() == want


def test_no_pages(spark, tmp_path):
    manifest = warc.write_archive(spark.createDataFrame([], SPEC), f"{tmp_path}/w")
    assert manifest.collect() == [] and warc.read_archive(manifest, f"{tmp_path}/w").collect() == []
