"""Staged batch pipeline.

Stage 1  event logs -> parsed-logs, contrib-signals, interest-signals,
         item-metadata, gravatar-ids, fork-map
Stage 2  interest-signals + item-metadata -> item-item-graph, item-item-recs
Stage 3  signals + graph + metadata -> user-contrib-recs, user-interest-recs
Stage 4  stage outputs -> keyed serving tables (optionally date-stamped)

Each stage reads the previous stage's *written* Parquet tables, which cuts
the lineage: a lost executor only recomputes work of the current stage.
With ``resume=True`` a stage whose outputs all carry ``_SUCCESS`` is skipped,
as long as no earlier stage ran and parameters and input are the same; the
input is known by its plan and by length and modification time of its files.
Paths should sit on shared storage (the cluster's checkpoint folder or any
DFS path); nothing is written to machine-local folders.
"""

from __future__ import annotations

import hashlib
import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from cograph.operators import events as E
from cograph.params import RecParams
from cograph.plans import recommenders as R
from cograph.sources import io as IO

SCANNED, QUARANTINE = "scanned-logs", "quarantine"  # of runs that read files
CANONICAL = "canonical-signals"  # both tracks before the split
DEDUPED = "user-recs"  # both channels after the de-duplication
STAGE1 = ["parsed-logs", "contrib-signals", "interest-signals", "item-metadata", "gravatar-ids", "fork-map"]
STAGE2 = ["item-item-graph", "item-item-recs"]
STAGE3 = ["user-contrib-recs", "user-interest-recs"]
SERVING = {  # name -> (hash key, range key)
    "gravatars": ("user", None),
    "item-recs": ("repo_lowered", "rank"),
    "user-contrib-recs": ("user_lowered", "rank"),
    "user-interest-recs": ("user_lowered", "rank"),
}


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def is_done(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_stage(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: IO.read_table(spark, _path(root, n)) for n in names}


def stage_parse(spark: SparkSession, logs: DataFrame, root: str,
                p: RecParams = RecParams.application(), skip: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Stage 1.  parsed-logs, fork-map and the canonical signals are written
    first and everything else is derived from the written copies, so the JSON is
    parsed once and the fork join runs once (S5).  ``skip`` leaves out tables a
    caller does not need; signal tracks that are left out are returned as
    filters of the canonical signals.

    Logs that were read with their malformed lines are scanned once into a table
    of both, from which the events go on and the lines go to ``quarantine``
    (file, line)."""
    if IO.MALFORMED in logs.columns:
        IO.write_table(E.parse_or_keep(logs, [IO.MALFORMED, IO.SOURCE_FILE]), _path(root, SCANNED))
        scanned = IO.read_table(spark, _path(root, SCANNED))
        IO.write_table(IO.quarantine(scanned), _path(root, QUARANTINE))
        IO.write_table(scanned.filter("is_event").select(*E.PARSED_COLUMNS), _path(root, "parsed-logs"))
    else:
        IO.write_table(E.parse_events(logs), _path(root, "parsed-logs"))
    parsed = IO.read_table(spark, _path(root, "parsed-logs"))
    skip = [*skip, "parsed-logs"]
    tables = stage_signals(spark, E.fork_map(parsed), parsed, E.latest_metadata(parsed), E.latest_gravatars(parsed), root, p, skip)
    return {"parsed-logs": parsed} | tables


def stage_signals(spark: SparkSession, forks: DataFrame, events: DataFrame, metadata: DataFrame, gravatars: DataFrame,
                  root: str, p: RecParams, skip: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The tables of stage 1 that come after the parsed events, or after the states of many days."""
    IO.write_table(forks, _path(root, "fork-map"))
    IO.write_table(E.canonical_signals(events, IO.read_table(spark, _path(root, "fork-map"))), _path(root, CANONICAL))
    sig = IO.read_table(spark, _path(root, CANONICAL))
    tracks = {"contrib-signals": E.contrib_signals(sig), "interest-signals": E.interest_signals(sig)}
    for name, track in tracks.items():
        if name not in skip:
            IO.write_table(track, _path(root, name))
    IO.write_table(E.item_quality(tracks["contrib-signals"], metadata, p.max_activity_considered),
                   _path(root, "item-metadata"), "item")
    if "gravatar-ids" not in skip:
        IO.write_table(gravatars, _path(root, "gravatar-ids"), "user")
    return tracks | read_stage(spark, root, [n for n in STAGE1 if n not in skip])


def stage_item_graph(spark: SparkSession, root: str, p: RecParams = RecParams.application(),
                     skip: Sequence[str] = (), tables: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Stage 2: quality-weighted, owner-diversified item graph and its output
    rows (``skip`` may leave out item-item-recs; ``tables`` are stage 1's, if at hand)."""
    t = tables or read_stage(spark, root, ["interest-signals", "item-metadata"])
    graph = R.quality_item_graph(t["interest-signals"], t["item-metadata"], p)
    IO.write_table(graph, _path(root, "item-item-graph"), "item_A")
    graph = IO.read_table(spark, _path(root, "item-item-graph"))
    if "item-item-recs" not in skip:
        IO.write_table(R.item_recs_output(graph, t["item-metadata"]), _path(root, "item-item-recs"), "item",
                       ["item", "rank"])
    return read_stage(spark, root, [n for n in STAGE2 if n not in skip])


def stage_user_recs(spark: SparkSession, root: str, p: RecParams = RecParams.application(),
                    prefer: str = "worst") -> dict[str, DataFrame]:
    """Stage 3: two-channel user recommendations; both channels are computed
    together, written once and then split."""
    t = read_stage(spark, root, ["contrib-signals", "interest-signals", "item-metadata", "item-item-graph"])
    signals = R.both_channels(t["contrib-signals"], t["interest-signals"])
    IO.write_table(R.channel_outputs(R.deduped_channels(signals, t["item-item-graph"], p, prefer), signals, t["item-metadata"]),
                   _path(root, DEDUPED), "user")
    both = IO.read_table(spark, _path(root, DEDUPED))
    for channel, name in enumerate(STAGE3, 1):
        IO.write_table(both.filter(both["channel"] == channel).drop("channel"), _path(root, name), "user", ["user", "rank"])
    return read_stage(spark, root, STAGE3)


def serving_frames(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    t = read_stage(spark, root, ["gravatar-ids", "item-item-recs"] + STAGE3)
    return {
        "gravatars": IO.serving_gravatars(t["gravatar-ids"]),
        "item-recs": IO.serving_item_recs(t["item-item-recs"]),
        "user-contrib-recs": IO.serving_user_recs(t["user-contrib-recs"]),
        "user-interest-recs": IO.serving_user_recs(t["user-interest-recs"]),
    }


def stage_serving(spark: SparkSession, root: str, serving_root: str,
                  snapshot: str | None = None) -> dict[str, str]:
    """Stage 4: keyed serving tables (S6), date-stamped when ``snapshot`` is given."""
    out = {}
    for name, df in serving_frames(spark, root).items():
        h, r = SERVING[name]
        out[name] = IO.write_serving_table(df, serving_root, name, h, r, snapshot)
    return out


RUN = "_run"  # what the stage tables below a root were made with


MANIFEST_SCHEMA = "run string, path string, length long, modified long"


def input_manifest(logs: DataFrame) -> list[tuple[str, int, int]]:
    """(path, length, modification time in ms) of the files that ``logs`` reads, as the file system has them now."""
    sc = logs.sparkSession.sparkContext
    conf, hadoop = sc._jsc.hadoopConfiguration(), sc._jvm.org.apache.hadoop.fs
    out = []
    for name in sorted(set(logs.inputFiles())):
        path = hadoop.Path(sc._jvm.java.net.URI(name))  # names come as URIs
        status = path.getFileSystem(conf).getFileStatus(path)
        out.append((name, int(status.getLen()), int(status.getModificationTime())))
    return out


def _same_run(spark: SparkSession, root: str, run: str, files: list[tuple[str, int, int]]) -> bool:
    path = _path(root, RUN)
    if not is_done(spark, path):
        return False
    known = spark.read.parquet(path)
    if known.columns != ["run", "path", "length", "modified"]:
        return False
    return {tuple(r) for r in known.collect()} == {(run, *f) for f in files or [(None, None, None)]}


def _plan_mark(logs: DataFrame) -> str:
    """Digest of the plan that leads from the files to ``logs``."""
    plan = re.sub(r"#[0-9]+L?", "", logs._jdf.queryExecution().analyzed().toString())
    return hashlib.sha1(plan.encode()).hexdigest()


def _unmark(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)


def run_pipeline(spark: SparkSession, event_logs: DataFrame | Sequence[str] | str, root: str,
                 p: RecParams = RecParams.application(), resume: bool = True,
                 snapshot: str | None = None, serving_root: str | None = None, prefer: str = "worst") -> list[str]:
    """Run the four stages; returns the names of the stages that did work.

    With ``resume`` a stage whose outputs are complete is skipped, unless an
    earlier stage ran, or the tables were made with other parameters or another
    input: parameters, ``prefer``, a digest of the input's plan and the input
    manifest (name, length and modification time of every file) are kept beside
    the tables, so files that were added, removed or rewritten in place start
    all stages again."""
    logs = event_logs if isinstance(event_logs, DataFrame) else IO.read_event_logs(spark, event_logs, keep_malformed=True)
    run, files = f"{p!r} prefer={prefer!r} plan={_plan_mark(logs)}", input_manifest(logs)
    serving_root = serving_root or _path(root, "serving")
    served = [n + (f"_{snapshot}" if snapshot else "") for n in SERVING]
    stages = [
        ("parse", [_path(root, n) for n in (*STAGE1, CANONICAL, *([SCANNED, QUARANTINE] if IO.MALFORMED in logs.columns else []))], lambda: stage_parse(spark, logs, root, p)),
        ("item_graph", [_path(root, n) for n in STAGE2], lambda: stage_item_graph(spark, root, p)),
        ("user_recs", [_path(root, n) for n in (*STAGE3, DEDUPED)], lambda: stage_user_recs(spark, root, p, prefer)),
        ("serving", [_path(serving_root, n) for n in served], lambda: stage_serving(spark, root, serving_root, snapshot))]
    first = 0
    if resume and _same_run(spark, root, run, files):
        first = next((i for i, (_, paths, _) in enumerate(stages) if not all(is_done(spark, x) for x in paths)), len(stages))
    for _, paths, _ in stages[first:]:  # nothing from here on counts as done any more, should this run break off
        for x in paths:
            _unmark(spark, x)
    if first == 0:
        rows = [(run, *f) for f in files or [(None, None, None)]]
        IO.write_table(spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1), _path(root, RUN))
    for _, _, work in stages[first:]:
        work()
    return [name for name, _, _ in stages[first:]]
