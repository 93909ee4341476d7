"""Notes about texts brought to the texts: one shuffle of each distinct text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cograph.llm.common import blocks, shuffle_partitions

BLOCK_BYTES = 16 << 20


def distinct_texts(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[list[tuple[int, int, bytes]]]:
    """Blocks of rows (k1, k2, text), each key of a block once."""
    for block in blocks(batches, "text", limit):
        rows: dict[tuple[int, int], bytes] = {}
        for k1, k2, text in zip(block.column("k1").to_pylist(), block.column("k2").to_pylist(), block.column("text")):
            if (k1, k2) not in rows:
                rows[k1, k2] = text.as_buffer().to_pybytes()
        yield [(*k, text) for k, text in rows.items()]


def with_texts(texts: DataFrame, notes: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (k1, k2, *columns, text): the notes of each text, then the text.
    ``columns`` are longs of ``notes``; a text is shuffled once per block that has it."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("text", pa.binary())])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in distinct_texts(batches):
            for i in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 256]), schema)], schema=schema)

    own = texts.select("k1", "k2", "text").mapInArrow(once, "k1 long, k2 long, text binary") \
        .select("k1", "k2", *(F.lit(None).cast("long").alias(c) for c in columns), "text")
    notes = notes.select("k1", "k2", *columns, F.lit(None).cast("binary").alias("text"))
    return own.union(notes).repartition(shuffle_partitions(texts.sparkSession), "k1", "k2") \
        .sortWithinPartitions("k1", "k2", F.col("text").isNotNull(), *columns)


def texts_and_notes(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, int, list[np.ndarray], bytes]]:
    """(k1, k2, note columns, text) of each text that has notes, from the rows of `with_texts`."""
    key, notes, done = None, [], False
    for batch in batches:
        k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
        texts = batch.column("text")
        at = 0
        for row in [*np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False)).tolist(), batch.num_rows]:
            if at < row:  # notes; their text may be in a later batch
                new = (int(k1[at]), int(k2[at]))
                if new != key:
                    key, notes, done = new, [], False
                notes.append([batch.column(c).slice(at, row - at).to_numpy(zero_copy_only=False) for c in columns])
            if row < batch.num_rows and (int(k1[row]), int(k2[row])) == key and not done:
                done = True
                yield *key, [np.concatenate(c) for c in zip(*notes)], texts[row].as_buffer().to_pybytes()
            at = row + 1
