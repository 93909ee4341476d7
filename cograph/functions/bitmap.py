"""Approximate membership before an exchange: a bitmap of hashed keys.

A semi join against many keys shuffles every row of its large side.  The bitmap
tells most rows that have no match where they are read: one bit per key at a
hash of it, kept in 64-bit words that are merged by a partial ``bit_or`` and
broadcast.  It never rejects a row that has a match, so an exact join may
follow and gives what it would give alone.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS_PER_KEY = 16
MOST_WORDS = 1 << 20  # rows of the broadcast: 8 MB of bits, for 4 million keys
KEY_BYTES = 16  # a key's part of a broadcast of the keys themselves, at least


def _slot(columns: Sequence[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def _hashable(rows: DataFrame, keys: DataFrame, columns: Sequence[str], key_columns: Sequence[str]) -> tuple[list[Column], list[Column]] | None:
    """Both sides' columns so that equal values have equal hashes, or None if their types do not allow it."""
    a, b = [], []
    for x, y in zip(columns, key_columns):
        own, other = rows.schema[x].dataType, keys.schema[y].dataType
        whole = isinstance(own, T.IntegralType) and isinstance(other, T.IntegralType)
        if isinstance(own, (T.FloatType, T.DoubleType)) or own != other and not whole:
            return None
        kind = T.LongType() if whole else own
        a.append(F.col(x).cast(kind))
        b.append(F.col(y).cast(kind))
    return a, b


def key_bitmap(keys: DataFrame, columns: Sequence[Column], bits: int) -> DataFrame:
    """(word, mask): the words in which a key has set a bit, at most bits / 64 rows."""
    set_bits = keys.select(_slot(columns, bits).alias("slot")).select(
        F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"))
    return set_bits.groupBy("word").agg(F.bit_or("bit").alias("mask"))


def prefilter(rows: DataFrame, keys: DataFrame, columns: Sequence[str], key_columns: Sequence[str] | None = None) -> DataFrame:
    """``rows`` without most of those whose ``columns`` are no key of ``keys``;
    no row with a key is lost, one with a null among them may be.

    ``keys`` is counted when this is called.  Where it is small enough to be
    broadcast itself, or so large that its bitmap would exceed MOST_WORDS, or
    the two sides' types differ in more than the width of integers, the rows
    come back as they are."""
    both = _hashable(rows, keys, columns, key_columns or columns)
    if both is None:
        return rows
    n = keys.count()
    limit = _bytes(rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    bits = max(64, n * BITS_PER_KEY)
    if n * KEY_BYTES <= limit or bits > MOST_WORDS * 64:
        return rows
    found = F.broadcast(key_bitmap(keys, both[1], bits))  # at most MOST_WORDS rows
    marked = rows.withColumn("__slot", _slot(both[0], bits))
    hit = marked.join(found, F.shiftright("__slot", 6) == F.col("word")).filter(F.expr("shiftright(mask, cast(__slot & 63 as int)) & 1 = 1"))
    return hit.select(*rows.columns)


def unsent(keys: DataFrame) -> DataFrame:
    """``keys``, kept from being broadcast where the threshold is too small for
    them: a plan takes them for as large as their compressed part of a file, which may be
    a small part of what the driver would hold.  They are counted when this is called."""
    limit = _bytes(keys.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    return keys.hint("merge") if keys.count() * KEY_BYTES > limit >= 0 else keys


def _bytes(text: str) -> int:
    """A size setting as bytes, such as 10MB or 256k."""
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    text = text.strip().lower().removesuffix("b")
    return int(text[:-1]) << units[text[-1]] if text[-1:] in units else int(text)
