"""Day-wise runs: a new day is merged into stored states.

The full pipeline reads all logs.  Here a day's logs are read once: its partial
states (arg-max rows and counts per key, `STATES`) are merged with the stored
ones of all earlier days, and the stage tables are derived from the merged
states.  The tables equal those of a full run over all days; the work of a day
grows with the day and with the number of distinct keys, not with the history.

States are kept in versions below ``<root>/states``.  A version counts once its
list of days is written, which comes last; a run that breaks off leaves the
version before it as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cograph.operators import events as E
from cograph.params import RecParams
from cograph.plans import pipeline as P
from cograph.sources import io as IO

#: Name -> (state of rows, key by which its table is written)
STATES = {"gravatars": (E.gravatar_state, "user"), "metadata": (E.metadata_state, "item"), "forks": (E.fork_state, "item"),
          "sources": (E.source_state, "repo_name"), "signals": (E.signal_state, "user")}
DAYS = "days"
DAYS_SCHEMA = "day string, path string, length long, modified long"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _version(root: str, n: int) -> str:
    return f"{root.rstrip('/')}/states/v{n:06d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    path, fs = _folder(spark, f"{root.rstrip('/')}/states")
    if not fs.exists(path):
        return []
    found = [int(s.getPath().getName()[1:]) for s in fs.listStatus(path)]
    return sorted(n for n in found if P.is_done(spark, f"{_version(root, n)}/{DAYS}"))


def merged_days(spark: SparkSession, root: str) -> dict[str, list[tuple]]:
    """Day -> (path, length, modified) of its files, of the latest version."""
    out: dict[str, list[tuple]] = {}
    if done := versions(spark, root):
        for r in IO.read_table(spark, f"{_version(root, done[-1])}/{DAYS}").collect():
            out.setdefault(r["day"], []).append((r["path"], r["length"], r["modified"]))
    return {day: sorted(files) for day, files in out.items()}


def read_states(spark: SparkSession, root: str, n: int) -> dict[str, DataFrame]:
    return {name: IO.read_table(spark, f"{_version(root, n)}/{name}") for name in STATES}


def advance(spark: SparkSession, logs: DataFrame, root: str, day: str, keep: int = 2) -> int:
    """Merge the logs of ``day`` into the states; returns the number of the
    version that holds them.

    A day that was merged before, from the same files, changes nothing.  The
    same day from other files is an error: an arg-max can't give back what was
    merged, so its states have to be rebuilt in a new folder.  Of the versions
    the last ``keep`` stay."""
    files = P.input_manifest(logs)
    done, days = versions(spark, root), merged_days(spark, root)
    if day in days:
        if days[day] != sorted(files):
            raise ValueError(f"day {day} was merged from other files: rebuild the states in a new folder")
        return done[-1]
    n = (done[-1] if done else 0) + 1
    IO.write_table(E.parse_events(logs), f"{_version(root, n)}/events")
    events = IO.read_table(spark, f"{_version(root, n)}/events")
    old = read_states(spark, root, done[-1]) if done else {}
    for name, (state, key) in STATES.items():
        new = state(events)
        IO.write_table(state(old[name].unionByName(new)) if old else new, f"{_version(root, n)}/{name}", key)
    rows = [(d, *f) for d, fs in {**days, day: files}.items() for f in fs or [(None, None, None)]]
    IO.write_table(spark.createDataFrame(rows, DAYS_SCHEMA).coalesce(1), f"{_version(root, n)}/{DAYS}")
    for stale in done[:len(done) + 1 - keep]:
        path, fs = _folder(spark, _version(root, stale))
        fs.delete(path, True)
    return n


def stage_from_states(spark: SparkSession, root: str, out: str, p: RecParams = RecParams.application()) -> dict[str, DataFrame]:
    """Stage 1's tables (all but the parsed logs) below ``out``, from the latest states."""
    s = read_states(spark, root, versions(spark, root)[-1])
    metadata = s["metadata"].select("item", (F.lit(2) * F.col("num_forks") + F.col("num_stars")).alias("popularity"),
                                    "num_forks", "num_stars", "language", "description")
    return P.stage_signals(spark, E.match_forks(s["forks"], s["sources"]), s["signals"], metadata,
                           s["gravatars"].select("user", "gravatar_id"), out, p, ["parsed-logs"])


def run_day(spark: SparkSession, logs: DataFrame, root: str, day: str, p: RecParams = RecParams.application(),
            serving_root: str | None = None, prefer: str = "worst") -> dict[str, str]:
    """One day: merge its logs, derive the tables of all days below
    ``<root>/tables`` and serve them, dated by the day."""
    advance(spark, logs, root, day)
    tables = f"{root.rstrip('/')}/tables"
    stage_from_states(spark, root, tables, p)
    P.stage_item_graph(spark, tables, p)
    P.stage_user_recs(spark, tables, p, prefer)
    return P.stage_serving(spark, tables, serving_root or f"{tables}/serving", day)
