"""Quality classifier: compressed sizes under a dictionary of good and a dictionary of bad text.

Two zstandard dictionaries are trained on labelled text of either kind.  A
text is compressed in chunks under both; the difference of the two sizes over
their sum is turned into a probability by a logistic curve fitted on other
labelled rows.  Only the fit looks at a bounded sample (`Fit`); scores read
every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from cograph.llm.common import scratch_table, small_batches, texts_of


@dataclass(frozen=True)
class Fit:
    """Bounds of the fit: labelled rows of each class for the dictionaries (at
    most half of a small class) and for the curve, chunks of their texts that a
    dictionary is built from, dictionary bytes."""

    dictionary_rows: int = 500
    curve_rows: int = 1000
    dictionary_chunks: int = 16_384
    dictionary_bytes: int = 1 << 20
    chunk_bytes: int = 1024
    level: int = 3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    fit: Fit

    def differences(self):
        """A function text bytes -> (bad size - good size) / (bad size + good size); 0 for an empty text."""
        made = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw) if raw else None
            if d:
                d.precompute_compress(level=self.fit.level)
            made.append(zstandard.ZstdCompressor(level=self.fit.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        good, bad = made
        step = self.fit.chunk_bytes

        def difference(text: bytes) -> float:
            a = b = 0
            for i in range(0, len(text), step):
                chunk = text[i:i + step]
                a += len(good(chunk))
                b += len(bad(chunk))
            return (b - a) / (b + a) if text else 0.0

        return difference


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """True for the rows no label may be learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


CHUNK_CHARS = 1024


def _dictionary(chunks: list[str], size: int) -> bytes:
    samples = [c.encode() for c in chunks]
    size = min(size, sum(map(len, samples)) // 4)
    if size < 256:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too uniform samples: their text itself is the dictionary
        return b"".join(samples)[-size:]


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of y on x by Newton steps, slightly ridged."""
    design = np.stack((x * 100, np.ones_like(x)), axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + np.eye(2) * 1e-3
        step = np.linalg.solve(hessian, design.T @ (weight * (y - p)) - 1e-3 * beta)
        beta += np.clip(step, -5, 5)
        if abs(step).max() < 1e-9:
            break
    return float(beta[0] * 100), float(beta[1])


def fit_quality(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> QualityModel:
    """Fit on labelled rows outside the held-out fold.

    For each class the rows with the smallest hash of doc_id are taken, at most
    ``dictionary_rows + curve_rows``: the first ``dictionary_rows``, or half of
    fewer, for its dictionary, the others for the curve.  A dictionary is built
    from whole texts, cut into chunks of 1,024 characters; if there are more
    than ``dictionary_chunks``, those of the smallest hashes are taken, from
    anywhere in the texts.  Null labels, labels other than 0 and 1 and labels without a
    document are ignored; repeated labels of a document count once, the larger
    one if they differ.  With one class or none, every score is the share of
    label 1 (1/2 without labels).
    """
    spark = docs.sparkSession
    rows = fit.dictionary_rows + fit.curve_rows
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .filter("doc_id is not null and quality in (0, 1)").filter(~held_out()) \
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    counts = dict(usable.groupBy("quality").count().collect())
    sample = []  # at most 2 * rows of (doc_id, class, whether it serves the dictionary)
    for q in (0, 1):
        ids = [r["doc_id"] for r in usable.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()]
        first = min(fit.dictionary_rows, len(ids) // 2)
        sample += [(i, q, n < first) for n, i in enumerate(ids)]
    picked = F.broadcast(spark.createDataFrame(sample, "doc_id long, quality int, turn boolean"))
    # an id with several texts has the one of the smallest hash
    labelled = texts_of(docs).join(picked, "doc_id").groupBy("doc_id", "quality", "turn").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    labelled = scratch_table(labelled, "quality-labelled")
    turn = F.col("turn")
    cuts = F.sequence(F.lit(0), F.greatest(F.length("text") - 1, F.lit(0)), F.lit(CHUNK_CHARS))
    chunk = labelled.filter(turn & (F.length("text") > 0)).select("doc_id", "quality", F.posexplode(F.transform(cuts, lambda i: F.substring(F.col("text"), i + 1, F.lit(CHUNK_CHARS)))).alias("at", "chunk"))
    texts = {q: [r["chunk"] for r in chunk.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at").limit(fit.dictionary_chunks).collect()] for q in (0, 1)}
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    model = QualityModel(_dictionary(texts[1], fit.dictionary_bytes), _dictionary(texts[0], fit.dictionary_bytes), 0.0, float(np.log(share / (1 - share))), fit)
    if min(counts.get(0, 0), counts.get(1, 0)) == 0:
        return model
    points = _differences(labelled.filter(~turn), model).select("quality", "difference").collect()
    x = np.array([r["difference"] for r in points])
    y = np.array([r["quality"] for r in points], float)
    if len(set(y.tolist())) < 2:
        return model
    weight = np.where(y == 1, counts[1] / max(1, y.sum()), counts[0] / max(1, (1 - y).sum()))
    slope, offset = _curve(x, y, weight * len(y) / weight.sum())
    return QualityModel(model.good, model.bad, slope, offset, fit)


def _differences(rows: DataFrame, model: QualityModel) -> DataFrame:
    """All columns of ``rows`` but text, and ``difference``."""
    kept = [f for f in rows.schema if f.name != "text"]
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", difference double"
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        difference = model.differences()
        for b in batches:
            d = pa.array([difference(t.as_buffer().to_pybytes()) for t in b.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), d], names=[*names, "difference"])

    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, spec)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, difference, score), one row per row of ``docs``.

    score is the probability of label 1.  A null or empty text has difference 0
    and the score of that point; a null doc_id is scored like any other.
    """
    rows = _differences(texts_of(docs), model)
    return rows.withColumn("score", 1 / (1 + F.exp(-(F.col("difference") * model.slope + F.lit(model.offset)))))


def keep_good(docs: DataFrame, model: QualityModel, cut: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least ``cut``, all columns; scores as in `score_quality`."""
    @F.pandas_udf("double")
    def differences(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        difference = model.differences()
        for t in texts:
            yield pd.Series([difference(x.encode("utf-8", "surrogatepass")) for x in t], dtype=float)

    small_batches(docs.sparkSession)
    score = 1 / (1 + F.exp(-(differences(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))) * model.slope + F.lit(model.offset))))
    return docs.filter(score >= cut)
