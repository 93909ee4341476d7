"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from cograph.session import stored

#: Arrow batches that go to Python hold at most this many bytes.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession, n_bytes: int = BATCH_BYTES) -> None:
    """Limit the bytes of an Arrow batch, so that whole texts of any length
    pass through Python with bounded memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(n_bytes))


def scratch_table(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: lineage
    ends here, and a lost executor costs only the tasks of the current stage."""
    return stored(df, name, codec)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, null text as empty; other columns never reach an operator."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def partitions_for(df: DataFrame, measure, unit: float, least: int = 1) -> int:
    """Number of partitions so that the sum of ``measure`` is about ``unit`` in each (one aggregate over ``df``)."""
    total = df.agg(F.sum(measure)).first()[0] or 0
    return max(least, int(-(-total // unit)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks(batches: Iterator[pa.RecordBatch], text_col: str, limit: int) -> Iterator[pa.Table]:
    """Arrow batches regrouped into tables of about ``limit`` text bytes; rows are never split or dropped."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start, n = 0, batch.num_rows
        if not n:
            continue
        offsets = pc.binary_length(batch.column(text_col)).to_numpy(zero_copy_only=False)
        for i in range(n):
            size += int(offsets[i])
            if size >= limit:
                held.append(batch.slice(start, i + 1 - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, i + 1
        if start < n:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def to_batches(columns: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Columns as record batches of at most 64k rows."""
    yield from pa.table(columns, schema=schema).to_batches(max_chunksize=65536)
