"""Event-log preparation.

Input EventLog: actor, actor_attributes{gravatar_id, company},
repository{owner, name, fork, language, description, stargazers, forks},
type, created_at.  "Latest" compares ``created_at`` as given (text, Q10);
ties are broken by the remaining columns, largest first, so results never
depend on row order.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cograph.functions.ranking import latest_by
from cograph.functions.skew import splittable_join

# Fixed values that must equal the reference's.
SIGNAL_EVENT_TYPES = ("ForkEvent", "PullRequestEvent", "PushEvent", "WatchEvent")
DEMO_REPO_NAMES = ("try_git", "Spoon-Knife")
CONTRIB_EVENT_TYPES = ("PushEvent", "PullRequestEvent")
FORK_EVENT_TYPE = "ForkEvent"
UNKNOWN_LANGUAGE = "Unknown"
DESCRIPTION_CHARS = 100
GRAVATAR_ID_CHARS = 32

PARSED_COLUMNS = ["user", "item", "signal", "timestamp", "gravatar_id", "repo_name", "is_a_fork",
                  "num_forks", "num_stars", "language", "description"]


def _desc(cols: Sequence[str]):
    return [F.desc_nulls_last(c) for c in cols]


def clean_events(logs: DataFrame, event_types: Sequence[str] = SIGNAL_EVENT_TYPES,
                 excluded_names: Sequence[str] = DEMO_REPO_NAMES) -> DataFrame:
    """Complete rows of the wanted event types, demo repos removed
    (case-sensitive, on the raw name).  Pushed down to the scan where possible."""
    return logs.filter(_is_clean(event_types, excluded_names))


def _is_clean(event_types: Sequence[str], excluded_names: Sequence[str]) -> Column:
    r = F.col("repository")
    return (F.col("actor").isNotNull() & r["owner"].isNotNull() & r["name"].isNotNull()
            & r["fork"].isNotNull() & F.col("type").isNotNull() & F.col("created_at").isNotNull()
            & F.col("type").isin(*event_types) & ~r["name"].isin(*excluded_names))


def _parsed_columns() -> list[Column]:
    """The parsed-log columns."""
    r = F.col("repository")
    return [
        F.lower("actor").alias("user"),
        F.lower(F.concat(r["owner"], F.lit("/"), r["name"])).alias("item"),
        F.col("type").alias("signal"),
        F.col("created_at").alias("timestamp"),
        F.col("actor_attributes.gravatar_id").alias("gravatar_id"),
        r["name"].alias("repo_name"),
        F.coalesce(r["fork"] == F.lit("true"), F.lit(False)).alias("is_a_fork"),
        r["forks"].alias("num_forks"),
        r["stargazers"].alias("num_stars"),
        F.coalesce(r["language"], F.lit(UNKNOWN_LANGUAGE)).alias("language"),
        F.substring(r["description"], 1, DESCRIPTION_CHARS).alias("description")]


def project_events(logs: DataFrame) -> DataFrame:
    """P2 + P3: the parsed-log columns; items with an empty owner drop."""
    return logs.select(*_parsed_columns()).filter(~F.col("item").startswith("/"))


def parse_events(logs: DataFrame) -> DataFrame:
    """P1-P3."""
    return project_events(clean_events(logs))


def parse_or_keep(logs: DataFrame, kept: Sequence[str]) -> DataFrame:
    """P1-P3 in one pass with the lines that could not be read: the parsed-log
    columns, ``is_event``, and the columns ``kept`` of the scan, of which the
    first is not null where the line was malformed.  A line can be both."""
    clean = F.coalesce(_is_clean(SIGNAL_EVENT_TYPES, DEMO_REPO_NAMES), F.lit(False))
    rows = logs.select(*_parsed_columns(), clean.alias("is_event"), *kept)
    rows = rows.withColumn("is_event", F.col("is_event") & ~F.col("item").startswith("/"))
    return rows.filter(F.col("is_event") | F.col(kept[0]).isNotNull())


# Mergeable states (A1, A7): each is an arg-max or a sum per key, so that for rows x and y
# state(x + y) == state(state(x) + state(y)).
def gravatar_state(rows: DataFrame) -> DataFrame:
    """Each user's latest 32-character avatar id -> user, timestamp, gravatar_id."""
    g = rows.filter(F.length("gravatar_id") == GRAVATAR_ID_CHARS).select("user", "timestamp", "gravatar_id")
    return latest_by(g, ["user"], _desc(["timestamp", "gravatar_id"]))


def metadata_state(rows: DataFrame) -> DataFrame:
    """The latest row of every non-fork item."""
    m = rows.filter(~F.col("is_a_fork")).select(
        "item", "timestamp", "is_a_fork", "num_forks", "num_stars", "language", "description")
    return latest_by(m, ["item"], _desc(["timestamp", "is_a_fork", "num_forks", "num_stars",
                                         "language", "description"]))


_FORK_COLUMNS = ["item", "timestamp", "repo_name", "is_a_fork", "num_forks", "language"]


def fork_state(rows: DataFrame) -> DataFrame:
    """The latest row of every fork."""
    return latest_by(rows.filter(F.col("is_a_fork")).select(*_FORK_COLUMNS), ["item"],
                     _desc(["timestamp", "repo_name", "is_a_fork", "num_forks", "language"]))


def source_state(rows: DataFrame) -> DataFrame:
    """The most-forked row of the non-fork items of every (name, language)."""
    return latest_by(rows.filter(~F.col("is_a_fork")).select(*_FORK_COLUMNS), ["repo_name", "language"],
                     _desc(["num_forks", "item", "timestamp"]))


def signal_state(rows: DataFrame) -> DataFrame:
    """Events of every (user, item, signal) -> user, item, signal, n; rows without ``n`` count once."""
    n = F.col("n") if "n" in rows.columns else F.lit(1).cast("long")
    return rows.groupBy("user", "item", "signal").agg(F.sum(n).alias("n"))


def latest_gravatars(parsed: DataFrame) -> DataFrame:
    """A7 + P4: each user's latest 32-character avatar id -> user, gravatar_id."""
    return gravatar_state(parsed).select("user", "gravatar_id")


def latest_metadata(parsed: DataFrame) -> DataFrame:
    """Latest state of every non-fork item; popularity = 2 * forks + stars.
    -> item, popularity, num_forks, num_stars, language, description."""
    return metadata_state(parsed).select(
        "item", (F.lit(2) * F.col("num_forks") + F.col("num_stars")).alias("popularity"),
        "num_forks", "num_stars", "language", "description")


def fork_map(parsed: DataFrame) -> DataFrame:
    """Map each fork to its assumed source, the most-forked non-fork item
    with the same (name, language).  -> fork_item, source_item."""
    return match_forks(fork_state(parsed), source_state(parsed))


def match_forks(forks: DataFrame, sources: DataFrame) -> DataFrame:
    """X1 from the states of forks and sources."""
    f, s = forks.alias("f"), sources.alias("s")
    return splittable_join(f, s, "f.repo_name", "s.repo_name", extra=[("f.language", "s.language")]).select(
        F.col("f.item").alias("fork_item"), F.col("s.item").alias("source_item"))


def canonical_signals(parsed: DataFrame, forks: DataFrame) -> DataFrame:
    """Events of a fork count for its source item, flagged mapped_from_fork.
    -> user, item, signal, mapped_from_fork.  Rows of `signal_state` give as many rows as they count events."""
    if "n" in parsed.columns:
        named = canonical_signals(parsed.select(F.struct("user", "n").alias("user"), "item", "signal"), forks)
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("user.n"))).alias("copy")
        return named.select("user.user", "item", "signal", "mapped_from_fork", copies).drop("copy")
    p, m = parsed.alias("p"), forks.alias("m")
    return p.join(m, F.col("p.item") == F.col("m.fork_item"), "left").select(
        F.col("p.user").alias("user"),
        F.coalesce(F.col("m.source_item"), F.col("p.item")).alias("item"),
        F.col("p.signal").alias("signal"),
        F.col("m.source_item").isNotNull().alias("mapped_from_fork"))


def _is_contrib():
    return F.col("signal").isin(*CONTRIB_EVENT_TYPES)


def contrib_signals(signals: DataFrame) -> DataFrame:
    """P6 + P7: contributions (push, pull request), weight 1."""
    return signals.filter(_is_contrib()).select(
        "user", "item", F.lit(1.0).alias("weight"), "mapped_from_fork")


def interest_signals(signals: DataFrame) -> DataFrame:
    """P6 + P7: everything else (stars, forks); a fork weighs 3, a star 1."""
    return signals.filter(~_is_contrib() | F.col("signal").isNull()).select(
        "user", "item",
        F.when(F.col("signal") == FORK_EVENT_TYPE, F.lit(3.0)).otherwise(F.lit(1.0)).alias("weight"),
        "mapped_from_fork")


def item_quality(contrib: DataFrame, metadata: DataFrame, max_activity: float = 64.0) -> DataFrame:
    """quality_score = popularity * sqrt(min(activity, cap)), activity =
    sum of contribution weights.  Items without contributions or metadata drop."""
    act = contrib.groupBy("item").agg(F.sum("weight").alias("activity"))
    a, m = act.alias("a"), metadata.alias("m")
    return a.join(m, F.col("a.item") == F.col("m.item")).select(
        F.col("m.item").alias("item"),
        (F.col("m.popularity") * F.sqrt(F.least(F.col("a.activity"), F.lit(float(max_activity)))))
        .alias("quality_score"),
        F.col("a.activity").alias("activity"), F.col("m.popularity").cast("double").alias("popularity"),
        "m.num_forks", "m.num_stars", "m.language", "m.description")


def prepare_events(logs: DataFrame, max_activity: float = 64.0) -> dict[str, DataFrame]:
    """The six stage outputs of event preparation (lazy)."""
    parsed = parse_events(logs)
    fm = fork_map(parsed)
    sig = canonical_signals(parsed, fm)
    contrib = contrib_signals(sig)
    meta = latest_metadata(parsed)
    return {
        "parsed-logs": parsed,
        "contrib-signals": contrib,
        "interest-signals": interest_signals(sig),
        "item-metadata": item_quality(contrib, meta, max_activity),
        "gravatar-ids": latest_gravatars(parsed),
        "fork-map": fm,
    }
