"""Keyed serving rows behind a Spark data source with commits.

``keyed_rows`` is a batch sink: every row is a put under its (hash, range) key,
so the last write of a key wins and writing the same rows again changes nothing.
Rows are dealt to buckets by their key; a task merges one bucket's puts, in key
order, with the bucket's present rows into a new file under a name taken from
its content.  Nothing of that is visible until the driver commits: it writes a
list of one file per bucket under the next number, which readers take from then
on.  A task that fails or is tried again leaves no rows, and an aborted write
leaves the table as it was.

One writer at a time: two at once would each commit on top of the same state,
and the second to finish is refused.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "keyed_rows"
BUCKET = "__bucket"


class Folder:
    """Files of one table, by any file system that Arrow knows."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(path)

    def lines(self, name: str) -> Iterator[str]:
        with self.fs.open_input_stream(f"{self.root}/{name}") as f:
            rest = b""
            while chunk := f.read(1 << 20):
                *whole, rest = (rest + chunk).split(b"\n")
                yield from (x.decode() for x in whole)

    def generations(self) -> list[int]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/commits", allow_not_found=True))
        return sorted(int(x.base_name) for x in found if x.base_name.isdigit())

    def current(self) -> tuple[int, dict[int, str]]:
        """(number of the last commit or 0, bucket -> file)."""
        n = max(self.generations(), default=0)
        return n, {int(b): f for b, f in json.loads("".join(self.lines(f"commits/{n}"))).items()} if n else {}

    def publish(self, n: int, files: dict[int, str]) -> None:
        """Makes ``files`` the table's; a commit of that number must not exist."""
        if n in self.generations():
            raise RuntimeError(f"commit {n} of {self.root} was made by another writer")
        self.fs.create_dir(f"{self.root}/commits", recursive=True)
        temporary = f"{self.root}/commits/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(temporary) as f:
            f.write((json.dumps(files, sort_keys=True) + "\n").encode())
        self.fs.move(temporary, f"{self.root}/commits/{n}")

    def drop(self, names: list[str]) -> None:
        from pyarrow import fs

        for x in names:
            if self.fs.get_file_info(f"{self.root}/{x}").type == fs.FileType.File:
                self.fs.delete_file(f"{self.root}/{x}")


@dataclass
class Merged(WriterCommitMessage):
    """New files of a task: bucket -> (file, whether this task made it)."""

    files: dict = field(default_factory=dict)


def merge(present: Iterator[tuple[list, str]], puts: Iterator[tuple[list, str]]) -> Iterator[tuple[list, str]]:
    """Rows (key, line) in key order, of both sides in key order; a put replaces
    the row of its key, the last of several puts counts."""
    last = None
    for key, _, line in heapq.merge(((k, 0, x) for k, x in present), ((k, 1, x) for k, x in puts), key=lambda r: (r[0], r[1])):
        if last is not None and last[0] != key:
            yield last
        last = key, line
    if last is not None:
        yield last


class KeyedWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.buckets = options["path"], int(options["buckets"])
        self.keys = json.loads(options["keys"])
        self.columns = [f.name for f in schema.fields if f.name != BUCKET]
        self.base, self.files = Folder(self.path).current()
        if self.files and len(self.files) != self.buckets:
            raise ValueError(f"{self.path} has {len(self.files)} buckets")

    def write(self, iterator: Iterator) -> Merged:
        """Merges the buckets of the rows, which come in the order of (bucket, key)."""
        out, made = Folder(self.path), {}

        def encoded(row) -> tuple[list, str]:
            return [row[k] for k in self.keys], json.dumps({c: row[c] for c in self.columns}, ensure_ascii=False, default=str)

        rows = iter(iterator)
        row = next(rows, None)
        while row is not None:
            bucket = row[BUCKET]

            def own() -> Iterator[tuple[list, str]]:
                nonlocal row
                while row is not None and row[BUCKET] == bucket:
                    yield encoded(row)
                    row = next(rows, None)

            old = self.files.get(bucket)
            present = (([json.loads(x)[k] for k in self.keys], x) for x in out.lines(old)) if old else iter(())
            made[bucket] = self._store(out, bucket, merge(present, own()))
        return Merged(files=made)

    def _store(self, out: Folder, bucket: int, rows: Iterator[tuple[list, str]]) -> tuple[str, bool]:
        out.fs.create_dir(f"{out.root}/rows", recursive=True)
        temporary, digest = f"{out.root}/rows/.{uuid.uuid4().hex}", hashlib.sha256()
        with out.fs.open_output_stream(temporary) as f:
            for _, line in rows:
                data = (line + "\n").encode()
                digest.update(data)
                f.write(data)
        name = f"rows/{bucket:05d}-{digest.hexdigest()[:32]}.json"
        new = name not in self.files.values()
        out.fs.move(temporary, f"{out.root}/{name}")  # a second attempt of the task makes the same file
        return name, new

    def commit(self, messages: list) -> None:
        out, files = Folder(self.path), dict(self.files)
        for m in messages:
            files |= {b: name for b, (name, _) in (m.files if m else {}).items()}
        for b in set(range(self.buckets)) - set(files):  # buckets without rows
            files[b] = self._store(out, b, iter(()))[0]
        if files != self.files:
            out.publish(self.base + 1, files)

    def abort(self, messages: list) -> None:
        made = [name for m in messages if m is not None for name, new in m.files.values() if new]
        Folder(self.path).drop(made)


class KeyedRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> KeyedWriter:
        if overwrite:
            raise ValueError("rows are put, not replaced as a whole: use mode append")
        return KeyedWriter(dict(self.options), schema)


def put_rows(df: DataFrame, path: str, hash_key: str, range_key: str | None = None, buckets: int = 64) -> None:
    """Put the rows of ``df`` into the keyed table at ``path`` (on shared
    storage): all of them or, should anything fail, none.

    Keys must not be null; of several rows with one key in ``df`` the greatest
    stays.  Rows are dealt by the whole key, so a hash key with very many range
    keys is spread over all buckets.  A table keeps its number of buckets."""
    keys = [hash_key] + ([range_key] if range_key else [])
    df.sparkSession.dataSource.register(KeyedRows)
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    bucket = F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in keys)), F.lit(buckets)).cast("int")
    rows = df.withColumn(BUCKET, F.when(null_key, F.raise_error(F.lit("a key is null")).cast("int")).otherwise(bucket))
    rows = rows.repartition(min(buckets, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), BUCKET) \
        .sortWithinPartitions(BUCKET, *keys, whole)
    rows.write.format(FORMAT).mode("append").option("path", path).option("buckets", buckets).option("keys", json.dumps(keys)).save()


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the last commit."""
    _, files = Folder(path).current()
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([f"{path.rstrip('/')}/{name}" for name in sorted(files.values())])
