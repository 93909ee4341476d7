"""Day-wise runs against full runs; quarantine; the input manifest."""

import json
import os

import pytest
from test_events_pipeline import G32, _ev, _write_logs

from cograph.operators import events as E
from cograph.params import RecParams
from cograph.plans import incremental as INC
from cograph.plans import pipeline as P
from cograph.sources import io as IO

PARAMS = RecParams.application().with_(min_link_weight=0.1)
DAYS = {
    "d1": [_ev("Alice", "own", "tool", False, "PushEvent", "2013-12-01T00:00:00", forks=9), _ev("bob", "fk", "tool", True, "ForkEvent", "2013-12-01T00:00:01"),
           _ev("bob", "fk", "tool", True, "ForkEvent", "2013-12-01T00:00:01"), _ev("carl", "own", "lib", False, "WatchEvent", "2013-12-01T00:00:02", grav=G32)],
    "d2": [_ev("bob", "fk", "tool", True, "PushEvent", "2013-12-02T00:00:00"), _ev("dora", "big", "tool", False, "WatchEvent", "2013-12-02T00:00:01", forks=50),
           _ev("Alice", "own", "tool", False, "PushEvent", "2013-12-02T00:00:02", forks=3, stars=8), _ev("alice", "own", "lib", False, "WatchEvent", "2013-11-30T00:00:00", forks=99)],
    "d3": [_ev("eve", "own", "lib", False, "PushEvent", "2013-12-03T00:00:00", lang="C"), _ev("carl", "fk", "tool", True, "WatchEvent", "2013-12-03T00:00:01", grav="f" * 32),
           _ev("carl", "own", "lib", False, "WatchEvent", "2013-12-03T00:00:02")],
}


def _write(folder, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n")
    return str(folder)


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_days_give_the_tables_of_a_full_run(spark, tmp_path):
    paths = {day: _write(tmp_path / day, rows) for day, rows in DAYS.items()}
    root, full = str(tmp_path / "inc"), str(tmp_path / "full")
    for n, day in enumerate(["d1", "d2"], 1):
        INC.advance(spark, IO.read_event_logs(spark, paths[day]), root, day)
        assert INC.versions(spark, root) == [1, 2][:n]
    served = INC.run_day(spark, IO.read_event_logs(spark, paths["d3"]), root, "d3", PARAMS)
    assert INC.versions(spark, root) == [2, 3] and set(served) == set(P.SERVING)
    P.run_pipeline(spark, list(paths.values()), full, PARAMS, snapshot="d3")  # as if all days had been read at once
    for name in [*P.STAGE1[1:], *P.STAGE2, *P.STAGE3]:
        assert _rows(spark.read.parquet(f"{root}/tables/{name}")) == _rows(spark.read.parquet(f"{full}/{name}")), name
    for name in P.SERVING:
        assert _rows(spark.read.parquet(f"{root}/tables/serving/{name}_d3")) == _rows(spark.read.parquet(f"{full}/serving/{name}_d3")), name


def test_a_day_is_merged_once_and_a_broken_merge_leaves_the_version_before(spark, tmp_path, monkeypatch):
    paths = {day: _write(tmp_path / day, rows) for day, rows in DAYS.items()}
    read = lambda day: IO.read_event_logs(spark, paths[day])
    root = str(tmp_path / "inc")
    assert INC.advance(spark, read("d1"), root, "d1") == 1 and INC.advance(spark, read("d1"), root, "d1") == 1
    states = {name: _rows(df) for name, df in INC.read_states(spark, root, 1).items()}

    def fail(*args, **kw):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setitem(INC.STATES, "sources", (fail, "repo_name"))
        with pytest.raises(OSError):
            INC.advance(spark, read("d2"), root, "d2")
    assert INC.versions(spark, root) == [1] and set(INC.merged_days(spark, root)) == {"d1"}
    assert {name: _rows(df) for name, df in INC.read_states(spark, root, 1).items()} == states
    assert INC.advance(spark, read("d2"), root, "d2") == 2 and set(INC.merged_days(spark, root)) == {"d1", "d2"}
    _write(tmp_path / "d1", DAYS["d1"] + DAYS["d3"])
    with pytest.raises(ValueError, match="other files"):
        INC.advance(spark, read("d1"), root, "d1")


def test_states_merge(spark, tmp_path):
    """state(x + y) == state(state(x) + state(y))."""
    parsed = [E.parse_events(IO.read_event_logs(spark, _write(tmp_path / day, rows))) for day, rows in DAYS.items()]
    for name, (state, _) in INC.STATES.items():
        at_once = state(parsed[0].union(parsed[1]).union(parsed[2]))
        merged = state(state(state(parsed[0]).union(state(parsed[1]))).union(state(parsed[2])))
        assert _rows(at_once) == _rows(merged), name


@pytest.fixture
def only_parsing(spark, monkeypatch):
    """The stages after the first write an empty table each."""
    def tables(names):
        def work(*args, **kw):
            root = next(a for a in args if isinstance(a, str))
            for n in names:
                IO.write_table(spark.range(0).toDF("x"), f"{root}/{n}")
        return work

    monkeypatch.setattr(P, "stage_item_graph", tables(P.STAGE2))
    monkeypatch.setattr(P, "stage_user_recs", tables([*P.STAGE3, P.DEDUPED]))
    monkeypatch.setattr(P, "stage_serving", tables([f"serving/{n}" for n in P.SERVING]))


def test_malformed_lines_are_kept(spark, tmp_path, only_parsing):
    paths = _write_logs(tmp_path)
    (tmp_path / "more").mkdir()
    odd = json.dumps(_ev("zoe", "own", "tool", False, "WatchEvent", "2014-01-02T00:00:00")).replace('"forks":', '"forks": "many", "x":')
    (tmp_path / "more" / "part-0.json").write_text('{"actor": \n' + odd + "\n\n[1, 2\n")
    root = str(tmp_path / "out")
    P.run_pipeline(spark, [*paths, str(tmp_path / "more")], root, PARAMS)
    lines = spark.read.parquet(f"{root}/{P.QUARANTINE}")
    assert sorted(r.line for r in lines.collect()) == sorted(["{not json", '{"actor": ', odd, "[1, 2"])
    counts = {os.path.basename(os.path.dirname(r.file)): r.lines for r in IO.quarantine_counts(lines).collect()}
    assert counts["more"] == 3 and sum(counts.values()) == 4
    parsed = spark.read.parquet(f"{root}/parsed-logs")
    assert parsed.columns == E.PARSED_COLUMNS
    assert _rows(parsed) == _rows(E.parse_events(IO.read_event_logs(spark, [*paths, str(tmp_path / "more")])))
    assert P.run_pipeline(spark, [*paths, str(tmp_path / "more")], root, PARAMS) == []


def test_a_file_rewritten_in_place_starts_all_stages_again(spark, tmp_path, only_parsing):
    path, root = _write(tmp_path / "logs", DAYS["d1"]), str(tmp_path / "out")
    every = ["parse", "item_graph", "user_recs", "serving"]
    assert P.run_pipeline(spark, path, root, PARAMS) == every and P.run_pipeline(spark, path, root, PARAMS) == []
    _write(tmp_path / "logs", DAYS["d1"] + DAYS["d2"])  # the same name
    assert P.run_pipeline(spark, path, root, PARAMS) == every
    assert spark.read.parquet(f"{root}/parsed-logs").count() == 8
    file = f"{path}/part.json"
    stamp = os.stat(file)
    os.utime(file, (stamp.st_atime, stamp.st_mtime + 5))  # the same length, another time
    assert P.run_pipeline(spark, path, root, PARAMS) == every
    _write(tmp_path / "logs two", DAYS["d3"])  # a name that is escaped in URIs
    assert P.run_pipeline(spark, [path, str(tmp_path / "logs two")], root, PARAMS) == every
    assert P.run_pipeline(spark, [path, str(tmp_path / "logs two")], root, PARAMS) == []
