"""Deterministic sharded WARC writer and reader.

Records are range-partitioned by page_id, then by the payload's digest, at cut
points that hold equal numbers of bytes between them, sorted, and written as one
gzip member each to files that roll at a compressed size.  A file gets a
temporary name until it is whole; the manifest, written last, names the files
that count.  Content and names depend on the rows alone, so a repeated task
writes the same file again; only equal rows are dealt by their place in the input.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cograph.functions.skew import salted_join
from cograph.llm.common import scratch_table, shuffle_partitions, small_batches
from cograph.session import scratch_folder

# fixed values of the format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 16
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


@dataclass(frozen=True)
class Writer:
    roll_bytes: int = 4 << 20
    shard_bytes: int = 16 << 20
    most_shards: int = 65_536  # shards grow beyond shard_bytes rather than become more
    least_revisit: int = 0  # smaller payloads are always written in full
    date: str = "1970-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"


def _header(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record, response or (with ``refers_to``) revisit."""
    digest = base32_sha1(payload)
    block = HTTP_HEAD.format(len(payload)).encode() + (payload if refers_to is None else b"")
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, url, digest)), ("WARC-Date", date)]
    if url:
        fields.append(("WARC-Target-URI", _header(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To-Page", str(refers_to))]
    if page_id is not None:
        fields.append(("WARC-Page", str(page_id)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
               ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as one gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse(archive: bytes) -> Iterator[dict]:
    """Records of an archive: their header fields, and ``payload``."""
    at, whole = 0, memoryview(archive)
    while at < len(whole):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if at >= len(whole):
                raise ValueError("truncated gzip member")
            part = whole[at:at + READ_BYTES]
            parts.append(z.decompress(part))
            at += len(part)
        at -= len(z.unused_data)
        data = b"".join(parts)
        head, _, body = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if version.encode() != VERSION:
            raise ValueError(f"not a record: {version[:40]}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = body[:int(fields["Content-Length"])]
        if body[len(block):] != b"\r\n\r\n" or "sha1:" + base32_sha1(block) != fields["WARC-Block-Digest"]:
            raise ValueError("damaged record")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
        yield fields | {"payload": payload, "size": size}


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, sha1, refers_to) of the pages whose payload a larger page_id has too; pages without id are never revisits."""
    seen = pages.select("page_id", F.sha1(F.col("html").cast("binary")).alias("sha1"), F.octet_length("html").alias("size")).filter("page_id is not null").filter(F.col("size") >= least)
    last = seen.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("first")).filter("first < refers_to").drop("first")
    return salted_join(seen.select("page_id", "sha1"), last, "sha1", hint="merge").filter("page_id < refers_to").select("page_id", "sha1", "refers_to").distinct()


def _place(html: str) -> list[Column]:
    """Order of a record: page_id (``low`` for null), the digest of its payload, a salt that deals equal records."""
    return [F.coalesce("page_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64(F.sha1(F.col(html).cast("binary"))).alias("digest"),
            F.xxhash64("url", F.monotonically_increasing_id()).alias("salt")]


def _cuts(pages: DataFrame, w: Writer) -> np.ndarray:
    """Place (id, digest, salt) of the first record of each shard but the first:
    rows in their order, cut wherever ``shard_bytes`` more have gone by."""
    sized = pages.select(*_place("html"), (F.octet_length("html") + 512).cast("long").alias("bytes"))
    order = ["id", "digest", "salt"]
    dealt = scratch_table(sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "warc-sizes")
    parts = dealt.groupBy("part").agg(F.sum("bytes").alias("bytes")).orderBy("part").collect()  # one row per task
    total = sum(r["bytes"] for r in parts)
    unit = max(w.shard_bytes, -(-total // w.most_shards))
    before, held = [], 0
    for r in parts:
        before.append((r["part"], held))
        held += r["bytes"]
    if held <= unit:
        return np.zeros((0, 3), np.int64)
    offsets = F.broadcast(pages.sparkSession.createDataFrame(before, "part int, held long"))  # one row per task
    so_far = F.sum("bytes").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    shard = F.floor((F.col("held") + F.coalesce(so_far, F.lit(0))) / unit)
    first = dealt.join(offsets, "part").withColumn("shard", shard).groupBy("shard").agg(F.min(F.struct(*order)).alias("first"))
    rows = first.orderBy("shard").select("first.*").collect()[1:]  # at most ``most_shards``
    return np.array([tuple(r) for r in rows], np.int64).reshape(-1, 3)


def shards_of(cuts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Shard of each place: the number of cuts that are not greater, compared by id, then digest, then salt."""
    low, high = np.zeros(len(places), np.int64), np.full(len(places), len(cuts))
    for i in range(cuts.shape[1]):
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        values, spans = np.unique(np.stack((low[open_], high[open_]), axis=1), axis=0, return_inverse=True)
        for n, (a, b) in enumerate(values.tolist()):
            rows = open_[spans.ravel() == n]
            low[rows] = a + np.searchsorted(cuts[a:b, i], places[rows, i], "left")
            high[rows] = a + np.searchsorted(cuts[a:b, i], places[rows, i], "right")
    return high


def _sharded(rows: DataFrame, cuts: np.ndarray, columns: list[str], name: str) -> DataFrame:
    if not len(cuts):
        return rows.withColumn(name, F.lit(0))
    told = rows.sparkSession.sparkContext.broadcast(cuts)  # at most ``most_shards``

    @F.pandas_udf("int")
    def shard(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(shards_of(told.value, np.stack((a, b, c), axis=1).astype(np.int64)), dtype="int32")

    return rows.withColumn(name, shard(*columns))


def write_archive(pages: DataFrame, out_dir: str, w: Writer = Writer()) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``out_dir``; returns the
    manifest (shard, part, name, records, bytes, sha1), also stored there.

    Null html is an empty payload; a null url gives no target header; a null
    page_id gives a response without page header.  Of equal payloads the
    largest page_id is the response, the others refer to it; repeated rows of
    that page are all responses.  An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    small_batches(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    cuts = _cuts(pages, w)
    pages = _sharded(pages.select("*", *_place("html")), cuts, ["id", "digest", "salt"], "shard").drop("id", "digest", "salt")
    # a revisit is told to every shard that can hold records of its page and payload
    notes = revisits(pages, w.least_revisit).select("page_id", "sha1", "refers_to", F.col("page_id").alias("id"), F.xxhash64("sha1").alias("digest"),
                                                    F.lit(-(1 << 63)).alias("least"), F.lit((1 << 63) - 1).alias("most"))
    notes = _sharded(_sharded(notes, cuts, ["id", "digest", "least"], "low"), cuts, ["id", "digest", "most"], "high")
    notes = notes.select(F.explode(F.sequence("low", "high")).alias("shard"), "page_id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.col("sha1").alias("html"), "refers_to")
    rows = pages.select("shard", "page_id", F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("long").alias("refers_to")).union(notes)
    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(out_dir)
        shard, part, records, size, sink, digest, temporary = None, 0, 0, 0, None, None, ""

        def close() -> pa.RecordBatch:
            sink.close()
            name = f"pages-{shard:06d}-{part:05d}.warc.gz"
            store.move(temporary, f"{folder}/{name}")
            return pa.RecordBatch.from_pylist([{"shard": shard, "part": part, "name": name, "records": records, "bytes": size, "sha1": digest.hexdigest()}], schema=schema)

        page, known = None, {}  # revisits of the page at hand, by digest of the payload
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("shard", "page_id", "kind", "url", "html", "refers_to"))):
                if row[1] != page:
                    page, known = row[1], {}
                if row[2] == 0:
                    known[row[4]] = row[5]
                    continue
                payload = row[4].encode("utf-8", "surrogatepass")
                refers_to = known.get(hashlib.sha1(payload).hexdigest()) if known else None
                data = member(record(row[1], row[3], payload, refers_to, w.date))
                if sink is not None and (row[0] != shard or size + len(data) > w.roll_bytes):
                    yield close()
                    part, sink = (part + 1 if row[0] == shard else 0), None
                if sink is None:
                    shard, records, size, digest = row[0], 0, 0, hashlib.sha1()
                    temporary = f"{folder}/.{uuid.uuid4().hex}.tmp"
                    sink = store.open_output_stream(temporary)
                sink.write(data)
                digest.update(data)
                records, size = records + 1, size + len(data)
        if sink is not None:
            yield close()

    _make_folder(out_dir)
    # one task for each shard at least, so that a task's bytes do not grow with the table
    written = rows.repartition(max(shuffle_partitions(spark), len(cuts) + 1), "shard").sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "kind", "url", "html") \
        .select("shard", "page_id", "kind", "url", "html", "refers_to").mapInArrow(run, "shard int, part int, name string, records long, bytes long, sha1 string")
    written.write.mode("errorifexists").parquet(f"{out_dir}/manifest")
    return spark.read.parquet(f"{out_dir}/manifest")


def _make_folder(out_dir: str) -> None:
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(out_dir)
    store.create_dir(folder, recursive=True)


def read_archive(manifest: DataFrame, out_dir: str, payloads: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload)
    of the records in the files that ``manifest`` names; a file that lacks, or
    whose size differs, is an error.  Without ``payloads`` that column is null."""
    spark = manifest.sparkSession
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: None if x is None else int(x)
        for b in batches:
            for name, size, archive in zip(*(b.column(c).to_pylist() for c in ("name", "bytes", "content"))):
                if archive is None or len(archive) != size:
                    raise ValueError(f"{name} is not the file of the manifest")
                held, held_bytes = [], 0
                for r in parse(archive):
                    payload = r["payload"] if r["WARC-Type"] == "response" else None
                    digest = r["WARC-Payload-Digest"].removeprefix("sha1:")
                    if payload is not None and (base32_sha1(payload) != digest or len(payload) != r["size"]):
                        raise ValueError("damaged payload")
                    held.append({"page_id": number(r.get("WARC-Page")), "url": r.get("WARC-Target-URI"), "record_type": r["WARC-Type"], "payload_bytes": r["size"],
                                 "payload_digest": digest, "refers_to": number(r.get("WARC-Refers-To-Page")), "payload": payload if payloads else None})
                    held_bytes += len(payload or b"") * payloads
                    if len(held) >= 1024 or held_bytes > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, held_bytes = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(out_dir) \
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return manifest.select("name", "bytes").join(found, "name", "left").mapInArrow(
        run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def archive_folder(spark) -> str:
    """A new folder below the shared checkpoint folder."""
    return scratch_folder(spark, "warc")
