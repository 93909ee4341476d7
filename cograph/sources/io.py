"""Scans and sinks."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cograph.session import shuffle_cleanup

EVENT_SCHEMA = T.StructType([
    T.StructField("actor", T.StringType()),
    T.StructField("actor_attributes", T.StructType([
        T.StructField("gravatar_id", T.StringType()),
        T.StructField("company", T.StringType()),
    ])),
    T.StructField("repository", T.StructType([
        T.StructField("owner", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("fork", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("stargazers", T.IntegerType()),
        T.StructField("forks", T.IntegerType()),
    ])),
    T.StructField("type", T.StringType()),
    T.StructField("created_at", T.StringType()),
])

# one convention for writing and reading delimited files: spaces, line breaks and empty strings survive;
# a string that is the null mark itself reads as null
QUOTING = {"quoteAll": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\\N", "lineSep": "\n",
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Fixed names: the fields of the event log above and of the serving tables below are the input and output format.
SIGNAL_SCHEMA = T.StructType([
    T.StructField("user", T.LongType()), T.StructField("item", T.LongType()),
    T.StructField("weight", T.DoubleType())])


# ----------------------------------------------------------------------------- S1, S2
MALFORMED, SOURCE_FILE = "_malformed", "_source_file"


def read_event_logs(spark: SparkSession, paths: Sequence[str] | str, keep_malformed: bool = False) -> DataFrame:
    """Newline-delimited JSON event logs with an explicit nested schema;
    several paths or globs are read as one relation.  Malformed lines become
    all-null rows (PERMISSIVE) and fall to the clean-up filter.

    With ``keep_malformed`` two more columns tell the text of a line that does
    not fit the schema (null for the others) and its file, for `quarantine`.  A
    line with a value of the wrong type is malformed too; its other fields are
    still read, so it may also be an event."""
    if isinstance(paths, str):
        paths = [paths]
    if not keep_malformed:
        return spark.read.schema(EVENT_SCHEMA).option("mode", "PERMISSIVE").json(list(paths))
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(MALFORMED, T.StringType())])
    logs = spark.read.schema(schema).options(mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED).json(list(paths))
    return logs.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


LOG_FILE_EVENTS = 1 << 18  # a compressed file is read by one task


def write_event_logs(logs: DataFrame, path: str) -> None:
    """JSON lines as `read_event_logs` reads them, gzipped: as plain text the log
    is many times the tables it is made from."""
    logs.write.option("maxRecordsPerFile", LOG_FILE_EVENTS).json(path, compression="gzip")


def quarantine(scanned: DataFrame) -> DataFrame:
    """(file, line) of the malformed lines of a scan that kept them."""
    return scanned.filter(F.col(MALFORMED).isNotNull()).select(F.col(SOURCE_FILE).alias("file"), F.col(MALFORMED).alias("line"))


def quarantine_counts(lines: DataFrame) -> DataFrame:
    """(file, lines): malformed lines of each file."""
    return lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"))


# ----------------------------------------------------------------------------- S3, S4
def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t") -> DataFrame:
    """S3: delimited text bound by position to ``schema`` (no header, no
    inference).  Quoted values may hold separators, quotes and line breaks."""
    return spark.read.schema(schema).options(sep=sep, header="false", **QUOTING, multiLine="true").csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Delimited sink; the target is replaced (overwrite).  Strings are
    quoted, an empty one is told from a null, quotes are doubled."""
    df.write.mode("overwrite").options(sep=sep, header="false", **QUOTING).csv(path)


def write_table(df: DataFrame, path: str, key: str | None = None,
                sort_by: Sequence[str] = ()) -> None:
    """Parquet stage table, replaced if present; its ``_SUCCESS`` marker
    tells the pipeline the stage is done.  With ``key`` the rows are
    rebalanced on it first (a ``rebalance`` hint: hash-partitioned, then AQE
    splits a partition made too large by a hot key and merges small ones), so
    the next stage reads evenly sized splits whatever the upstream parallelism
    was.  ``sort_by`` orders rows within each file (no global sort).  The shuffle
    files it was made from are removed with the write."""
    if key is not None:
        df = df.hint("rebalance", key)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    with shuffle_cleanup(df.sparkSession):
        df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ----------------------------------------------------------------------------- S6, S7
def check_serving_keys(df: DataFrame, hash_key: str, range_key: str | None = None) -> None:
    """The (hash, range) key must be non-null and unique: one aggregation job."""
    keys = [hash_key] + ([range_key] if range_key else [])
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    bad = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
           .filter((F.col("n") > 1) | null_key).limit(1).count())
    if bad:
        raise ValueError(f"serving key {keys} is null or not unique")


def write_serving_table(df: DataFrame, root: str, name: str, hash_key: str, range_key: str | None = None,
                        snapshot: str | None = None, check: bool = True) -> str:
    """Keyed serving table.  Rows of one hash key land in one file,
    sorted by (hash, range) so a key-value store can be bulk-loaded from it.
    ``snapshot`` (e.g. a date) names a dated copy ``<name>_<snapshot>``."""
    if check:
        check_serving_keys(df, hash_key, range_key)
    keys = [hash_key] + ([range_key] if range_key else [])
    path = f"{root.rstrip('/')}/{name}" + (f"_{snapshot}" if snapshot else "")
    df.repartition(hash_key).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return path


def serving_item_recs(item_recs_output: DataFrame) -> DataFrame:
    """Item-rec serving rows keyed by (repo_lowered, rank)."""
    r = item_recs_output
    return r.select(F.col("item").alias("repo_lowered"), "rank", "rec", F.col("language").alias("lang"),
                    F.col("num_forks").alias("forks"), F.col("num_stars").alias("stars"), "description")


def serving_user_recs(user_recs_output: DataFrame) -> DataFrame:
    """User-rec serving rows keyed by (user_lowered, rank)."""
    r = user_recs_output
    return r.select(F.col("user").alias("user_lowered"), "rank", F.col("item").alias("rec"),
                    F.col("reason_item").alias("reason"), F.col("mapped_from_fork").alias("reason_flag"),
                    F.col("num_forks").alias("forks"), F.col("num_stars").alias("stars"),
                    F.col("language").alias("lang"), "description")


def serving_gravatars(gravatar_ids: DataFrame) -> DataFrame:
    """Avatar serving rows keyed by user (distinct rows)."""
    return gravatar_ids.select("user", F.col("gravatar_id").alias("gravatar")).distinct()
