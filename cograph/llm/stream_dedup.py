"""Exact deduplication of documents by a stateful stream.

Documents stream in by files.  For each digest the keyed state keeps how many
texts had it, the stable identifier of the one that stays (the largest doc_id)
and a locator of its content (file, row).  The state lies in RocksDB on the
executors' disks, saved to the shared checkpoint folder with every batch, and
never expires: a later run over the same folder reads new files only.

A digest that is met again is a hit, not yet a copy: the row's whole text is
compared with the text at the locator.  Texts that differ from it in spite of an
equal digest are grouped by their full bytes.  DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cograph.functions.skew import splittable_join
from cograph.llm.common import scratch_table

#: Settings of the state: RocksDB, without space set aside for the logs of each of many small stores.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
CORE_BYTES = 64 << 20  # of a batch, for each core


@dataclass(frozen=True)
class Source:
    """A Parquet table of texts.  ``digest_bytes`` of the text's sha256 are the
    key of the state; fewer only make more texts meet there, never other results."""

    path: str
    id_col: str = "doc_id"
    text_col: str = "text"
    digest_bytes: int = 32

    def schema(self, spark: SparkSession) -> T.StructType:
        found = spark.read.parquet(self.path).schema
        return T.StructType([found[self.id_col], found[self.text_col]])

    def rows(self, spark: SparkSession) -> DataFrame:
        return self._keyed(spark.read.schema(self.schema(spark)).parquet(self.path))

    def stream(self, spark: SparkSession, batch_bytes: int | None = None) -> DataFrame:
        """The rows as a stream, in batches of files of about ``batch_bytes``."""
        path = self.path.rstrip("/")
        path = f"{path[:-1]}[{path[-1]}]"  # a pattern of one name: the table may be a folder or a single file
        size = batch_bytes or CORE_BYTES * spark.sparkContext.defaultParallelism
        return self._keyed(spark.readStream.schema(self.schema(spark)).options(maxBytesPerTrigger=str(size), maxFileAge="36500d").parquet(path))

    def _keyed(self, df: DataFrame) -> DataFrame:
        at = df.metadataColumn("_metadata")
        text = F.coalesce(F.col(f"`{self.text_col}`").cast("string"), F.lit(""))
        sha = F.unhex(F.sha2(text, 256))
        return df.select(F.col(f"`{self.id_col}`").cast("long").alias("doc_id"), text.alias("text"), sha.alias("sha"),
                         F.substring(sha, 1, self.digest_bytes).alias("digest"), at["file_path"].alias("file"), at["row_index"].alias("row"))


def _stays() -> Column:
    """The largest doc_id, a null one last; equal ids go by file and row."""
    return F.max(F.struct("doc_id", "file", "row"))


def absorb(source: Source, spark: SparkSession, folder: str, batch_bytes: int | None = None) -> DataFrame:
    """Takes what is new in the table into the state kept in ``folder`` (on
    shared storage, one folder for one table) and returns the whole state:
    (digest, keep struct<doc_id, file, row>, n)."""
    state = source.stream(spark, batch_bytes).groupBy("digest").agg(_stays().alias("keep"), F.count("*").alias("n"))
    before = {c: spark.conf.get(c, None) for c in STATE_CONF}
    for c, value in STATE_CONF.items():
        spark.conf.set(c, value)
    try:
        query = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", folder).trigger(availableNow=True).start()
        query.awaitTermination()
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/state")
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):  # no file has come yet
            return spark.createDataFrame([], "digest binary, keep struct<doc_id: long, file: string, row: long>, n long")
        kept = spark.read.format("statestore").option("path", folder).load()
        return scratch_table(kept.select("key.digest", "value.*").toDF("digest", "keep", "n"), "dedup-digests")
    finally:
        for c, value in before.items():
            spark.conf.unset(c) if value is None else spark.conf.set(c, value)


def resolve(rows: DataFrame, state: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, sha) of every row, from the rows and the state of all of them."""
    hits = state.filter("n > 1").select("digest", F.col("keep.doc_id").alias("keep_id"), F.col("keep.file").alias("keep_file"), F.col("keep.row").alias("keep_row"), "n")
    hit = F.col("s.n").isNotNull()
    met = scratch_table(splittable_join(rows.alias("r"), hits.alias("s"), "r.digest", "s.digest", "left").select(
        "r.doc_id", "r.sha", F.when(hit, F.col("r.digest")).alias("digest"), F.when(hit, F.col("r.text")).alias("text"), F.when(hit, F.col("r.file")).alias("file"),
        "r.row", "s.keep_id", "s.n", ((F.col("r.file") == F.col("s.keep_file")) & (F.col("r.row") == F.col("s.keep_row"))).alias("kept")), "dedup-hits")
    alone = met.filter("n is null").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")

    content = met.filter("kept").select("digest", F.col("text").alias("content"))  # what the locators point to
    same = F.coalesce(F.col("h.text") == F.col("c.content"), F.lit(False))
    checked = scratch_table(splittable_join(met.filter("n is not null").alias("h"), content.alias("c"), "h.digest", "c.digest", "left").select(
        "h.doc_id", "h.sha", "h.digest", F.when(~same, F.col("h.text")).alias("text"), "h.file", "h.row", "h.keep_id", "h.n", "h.kept", same.alias("same")), "dedup-checked")

    others = checked.filter("not same")
    lost = others.groupBy("digest").agg(F.count("*").alias("lost"))
    copies = splittable_join(checked.filter("same").alias("x"), lost.alias("l"), "x.digest", "l.digest", "left").select(
        "x.doc_id", "x.keep_id", (F.col("x.n") - F.coalesce("l.lost", F.lit(0))).alias("group_size"), "x.kept", "x.sha")
    groups = others.groupBy("digest", "text").agg(_stays().alias("keep"), F.count("*").alias("size"))
    apart = splittable_join(others.alias("x"), groups.alias("g"), "x.digest", "g.digest", extra=[("x.text", "g.text")]).select(
        "x.doc_id", F.col("g.keep.doc_id").alias("keep_id"), F.col("g.size").alias("group_size"),
        ((F.col("x.file") == F.col("g.keep.file")) & (F.col("x.row") == F.col("g.keep.row"))).alias("kept"), "x.sha")
    return alone.unionByName(copies).unionByName(apart)


def exact_duplicates(spark: SparkSession, source: Source, folder: str, batch_bytes: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of the table.

    Null texts count as empty; texts are equal when all their bytes are.  Of
    equal texts the row with the largest doc_id stays (a null id only if no
    other has one; of repeated ids one row), ``keep_id`` is its doc_id.  Every
    row of the table has one row here, repeated ones too; an empty table has
    none; other columns are not read.  ``folder`` keeps the stream's state; the
    table may have grown since an earlier run over it, but must not change
    during one.
    """
    state = absorb(source, spark, folder, batch_bytes)
    return resolve(source.rows(spark), state).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
