import json
import os
import shutil

import pytest

from cograph.operators import events as E
from cograph.params import RecParams
from cograph.plans import pipeline as P
from cograph.sources import io as IO


def _ev(actor, owner, name, fork, etype, ts, lang="Python", desc="d", grav=None, forks=1, stars=2):
    return {"actor": actor, "actor_attributes": {"gravatar_id": grav, "company": None},
            "repository": {"owner": owner, "name": name, "fork": fork, "language": lang, "description": desc,
                           "stargazers": stars, "forks": forks},
            "type": etype, "created_at": ts}


G32 = "0123456789abcdef0123456789abcdef"


def _write_logs(tmp_path):
    d1, d2 = tmp_path / "2013", tmp_path / "2014"
    d1.mkdir(), d2.mkdir()
    a = [_ev("Alice", "Own", "Tool", False, "WatchEvent", "2013-12-01T00:00:01", desc="x" * 150, grav=G32),
         _ev("alice", "own", "tool", "false", "PushEvent", "2013-12-01T00:00:02", grav="short"),
         _ev("bob", "fk", "Tool", True, "ForkEvent", "2013-12-01T00:00:03", forks=0),
         _ev("bob", "fk", "Tool", True, "PushEvent", "2013-12-01T00:00:04", forks=0),
         _ev(None, "own", "tool", False, "PushEvent", "2013-12-01T00:00:05"),
         _ev("carl", "", "x", False, "PushEvent", "2013-12-01T00:00:06"),
         _ev("carl", "own", "try_git", False, "PushEvent", "2013-12-01T00:00:07"),
         _ev("carl", "own", "tool", False, "IssuesEvent", "2013-12-01T00:00:08"),
         _ev("dora", "own", "Tool", False, "PullRequestEvent", "2013-12-02T00:00:00", lang=None, forks=5, stars=1)]
    (d1 / "part-0.json").write_text("\n".join(json.dumps(r) for r in a) + "\n{not json\n")
    b = [_ev("Bob", "Own", "Tool", False, "WatchEvent", "2014-01-01T00:00:00", grav=G32, forks=7, stars=3)]
    (d2 / "part-0.json").write_text("\n".join(json.dumps(r) for r in b) + "\n")
    return [str(d1), str(d2)]


def test_event_scan_and_parse(spark, tmp_path):
    logs = IO.read_event_logs(spark, _write_logs(tmp_path))
    assert logs.count() == 11                       # bad line -> all-null row
    parsed = E.parse_events(logs)
    rows = sorted((r.user, r.item, r.signal, r.is_a_fork, r.language) for r in parsed.collect())
    assert rows == [("alice", "own/tool", "PushEvent", False, "Python"),
                    ("alice", "own/tool", "WatchEvent", False, "Python"),
                    ("bob", "fk/tool", "ForkEvent", True, "Python"),
                    ("bob", "fk/tool", "PushEvent", True, "Python"),
                    ("bob", "own/tool", "WatchEvent", False, "Python"),
                    ("dora", "own/tool", "PullRequestEvent", False, "Unknown")]
    assert max(len(r.description) for r in parsed.collect()) == 100


def test_event_preparation_outputs(spark, tmp_path):
    out = E.prepare_events(IO.read_event_logs(spark, _write_logs(tmp_path)))
    fm = [(r.fork_item, r.source_item) for r in out["fork-map"].collect()]
    assert fm == [("fk/tool", "own/tool")]           # same (name, language), most forked source
    contrib = sorted((r.user, r.item, r.weight, r.mapped_from_fork) for r in out["contrib-signals"].collect())
    assert contrib == [("alice", "own/tool", 1.0, False), ("bob", "own/tool", 1.0, True),
                       ("dora", "own/tool", 1.0, False)]
    interest = sorted((r.user, r.item, r.weight) for r in out["interest-signals"].collect())
    assert interest == [("alice", "own/tool", 1.0), ("bob", "own/tool", 1.0), ("bob", "own/tool", 3.0)]
    grav = sorted((r.user, r.gravatar_id) for r in out["gravatar-ids"].collect())
    assert grav == [("alice", G32), ("bob", G32)]
    meta = {r.item: r for r in out["item-metadata"].collect()}
    m = meta["own/tool"]                            # latest non-fork state: 2014 row
    assert (m.num_forks, m.num_stars, m.popularity) == (7, 3, 17.0)
    assert m.activity == 3.0 and m.quality_score == pytest.approx(17 * 3 ** 0.5)


def test_pipeline_runs_and_resumes(spark, tmp_path):
    paths = _write_logs(tmp_path)
    root = str(tmp_path / "out")
    ran = P.run_pipeline(spark, paths, root, snapshot="2014-01-01")
    assert ran == ["parse", "item_graph", "user_recs", "serving"]
    for name in P.STAGE1 + P.STAGE2 + P.STAGE3:
        assert P.is_done(spark, f"{root}/{name}")
    assert os.path.isdir(f"{root}/serving/item-recs_2014-01-01")
    assert P.run_pipeline(spark, paths, root, snapshot="2014-01-01") == []
    grav = spark.read.parquet(f"{root}/serving/gravatars_2014-01-01")
    assert sorted(grav.columns) == ["gravatar", "user"] and grav.count() == 2


def test_pipeline_serves_no_stale_tables(spark, tmp_path):
    paths, root = _write_logs(tmp_path), str(tmp_path / "out")
    p = RecParams.application().with_(min_link_weight=0.1)
    every = ["parse", "item_graph", "user_recs", "serving"]
    run = lambda **kw: P.run_pipeline(spark, paths, root, **({"p": p} | kw))
    assert run() == every and run() == []
    shutil.rmtree(f"{root}/fork-map")
    assert run() == every                                   # all that was derived from it
    shutil.rmtree(f"{root}/user-recs")
    assert run() == ["user_recs", "serving"]
    assert run(p=p.with_(prior=1.0)) == every               # other parameters
    assert run(p=p.with_(prior=1.0), prefer="best") == every
    assert run(p=p.with_(prior=1.0), prefer="best", snapshot="d2") == ["serving"]
    assert run(p=p.with_(prior=1.0), prefer="best", resume=False) == every
    with open(tmp_path / "more.json", "w") as f:
        f.write("{}\n")
    assert P.run_pipeline(spark, [*([paths] if isinstance(paths, str) else paths), str(tmp_path / "more.json")], root, p=p.with_(prior=1.0), prefer="best") == every


def test_a_broken_run_leaves_nothing_marked_as_done(spark, tmp_path, monkeypatch):
    paths, root = _write_logs(tmp_path), str(tmp_path / "out")
    p = RecParams.application().with_(min_link_weight=0.1)
    P.run_pipeline(spark, paths, root, p)

    def fail(*args, **kw):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(P, "stage_item_graph", fail)
        with pytest.raises(OSError):
            P.run_pipeline(spark, paths, root, p.with_(prior=1.0))
    assert P.run_pipeline(spark, paths, root, p.with_(prior=1.0)) == ["item_graph", "user_recs", "serving"]


def test_delimited_text_survives(spark, tmp_path):
    rows = [("a\tb", "line\r\nbreak\n", True, 1), ('"quoted"', "", False, 2), (" blanks ", None, None, None), ("n", "back\\slash", True, 3), ("", "é😀", False, 4)]
    df = spark.createDataFrame(rows, "a string, b string, c boolean, d int")
    IO.write_delimited(df, str(tmp_path / "t"))
    back = [tuple(r) for r in IO.read_delimited(spark, str(tmp_path / "t"), df.schema).collect()]
    assert sorted(back, key=str) == sorted(rows, key=str)


def test_serving_key_check(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 1)], "repo_lowered string, rank int")
    with pytest.raises(ValueError):
        IO.write_serving_table(df, str(tmp_path), "t", "repo_lowered", "rank")
    ok = spark.createDataFrame([("a", 1), ("a", 2)], "repo_lowered string, rank int")
    path = IO.write_serving_table(ok, str(tmp_path), "t", "repo_lowered", "rank", snapshot="d1")
    assert path.endswith("t_d1") and spark.read.parquet(path).count() == 2


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3.0), (4, 5, 1.0)], "user bigint, item bigint, weight double")
    IO.write_delimited(df, str(tmp_path / "tsv"))
    back = IO.read_delimited(spark, str(tmp_path / "tsv"), IO.SIGNAL_SCHEMA)
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2, 3.0), (4, 5, 1.0)]


def test_scratch_dir_when_the_session_has_none():
    from cograph.session import scratch_dir

    class Ctx:
        master = "local[4]"

        def __init__(self):
            self.d = None

        def getCheckpointDir(self):
            return self.d

        def setCheckpointDir(self, d):
            self.d = "file:" + d + "/abc"

    class Conf:
        def get(self, key, default=None):
            return default

        def set(self, key, value):
            raise AssertionError("spark.checkpoint.dir cannot be set on a running session")

    class FakeSession:
        sparkContext = Ctx()
        conf = Conf()

    fake = FakeSession()
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):  # executors elsewhere would not see a private folder
        fake.sparkContext.master = master
        with pytest.raises(RuntimeError):
            scratch_dir(fake)
    fake.sparkContext.master = "local[4]"
    d = scratch_dir(fake)
    assert d.endswith("/abc") and not d.startswith("file:")
    assert scratch_dir(fake) == d


def test_event_logs_are_written_compressed(spark, tmp_path, monkeypatch):
    """The log takes far less room than as plain text, in files of a bounded number of events."""
    monkeypatch.setattr(IO, "LOG_FILE_EVENTS", 300)
    r = {"owner": "o", "name": "n", "fork": "true", "language": None, "description": "x" * 150, "stargazers": 4, "forks": 1}
    rows = [(f"u{i}", {"gravatar_id": None, "company": None}, r, "ForkEvent", "2012-01-01T00:00:00") for i in range(1000)]
    logs = spark.createDataFrame(rows, IO.EVENT_SCHEMA).coalesce(1)
    IO.write_event_logs(logs, f"{tmp_path}/logs")
    logs.write.json(f"{tmp_path}/plain")
    files = lambda name: [os.path.getsize(f"{tmp_path}/{name}/{f}") for f in os.listdir(f"{tmp_path}/{name}") if f.startswith("part-")]
    assert len(files("logs")) == 4 and sum(files("logs")) < sum(files("plain")) / 5
    back = IO.read_event_logs(spark, f"{tmp_path}/logs")
    assert sorted(x.actor for x in back.collect()) == sorted(x[0] for x in rows)
    assert back.select("repository.*").distinct().count() == 1


def test_quarantine_keeps_its_log_gzipped(spark, monkeypatch):
    """As plain text the log is many times the tables it is made from."""
    from cograph.plans import queries as PQ
    roots = []
    real = PQ.scratch_folder
    monkeypatch.setattr(PQ, "scratch_folder", lambda s, name: roots.append(real(s, name)) or roots[-1])
    found = PQ.SPARK["quarantine"](spark, "/root/testdata/sf0.001")
    assert {r.kind for r in found.collect()} == {"malformed", "event"}
    files = [f for f in os.listdir(f"{roots[0]}/logs") if f.startswith("part-")]
    assert files and all(f.endswith(".txt.gz") for f in files)
