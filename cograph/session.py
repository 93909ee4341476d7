"""Session helpers: a tuned local session for tests and benchmarks, and the
shared scratch folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # small local inputs that explode in self-joins still get spread over the cores
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "cograph",
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF, **{"spark.sql.shuffle.partitions": str(shuffle_partitions),
                                 "spark.driver.memory": "16g"})
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (the checkpoint
    folder of the SparkContext).  A local session without one, as in tests, gets
    a private temporary folder; on a cluster that would be invisible to the
    executors and is an error."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cograph-ckpt-"))
        d = sc.getCheckpointDir()
    d = str(d)
    return d[len("file:"):] if d.startswith("file:") and not d.startswith("file://") else d


#: Spark removes the shuffle files of an execution when that ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: list[tuple] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables below the shared folder.  Results may
    be read lazily at any time, so it is removed when the driver ends (or by `discard`)."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove_scratch)
    _made.append((spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path))
    return path


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of an execution are removed when that ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: evaluated once, whatever
    reads it, and a lost executor cannot change what later steps see.  With the
    table committed, the shuffle files it was made from are removed."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    with shuffle_cleanup(spark):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_in_parts(parts: Iterable[DataFrame], name: str, codec: str = "snappy") -> DataFrame:
    """Tables of one schema written one after the other to one folder and read
    again: the shuffle files of a part are removed before the next is made."""
    path = None
    for part in parts:
        spark = part.sparkSession
        path = path or scratch_folder(spark, name)
        with shuffle_cleanup(spark):
            part.write.option("compression", codec).mode("append").parquet(path)
    return spark.read.schema(part.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes the files of a `stored` table that nothing reads any more."""
    files = table.inputFiles()
    for made in [m for m in _made if files and f"/{m[2].rsplit('/', 1)[-1]}/" in files[0]]:
        jvm, conf, path = made
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        _made.remove(made)


def _remove_scratch() -> None:
    for jvm, conf, path in _made:
        try:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        except Exception:  # noqa: BLE001 - the JVM may have ended before
            return
