"""Item-item graph operators.

Schemas (column names are the contract; key columns may be any orderable type):
  signals       user, item, weight
  ii_links      item_A, item_B, weight [, raw_weight]
  item_weights  item, overall_weight
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cograph.functions.ranking import distributed_rank, rank_within, top_k
from cograph.functions.scale import logistic_scale, popularity_boost, sort_key
from cograph.functions.skew import splittable_join
from cograph.session import discard, stored, stored_in_parts


# --------------------------------------------------------------------------- G1, G2
def aggregate_signals(signals: DataFrame, logistic_param: float) -> DataFrame:
    """G1: drop null keys, sum weight per (user, item) and scale it logistically.

    One hash aggregate with a map-side partial sum, so a hot (user, item) pair
    is collapsed before the shuffle."""
    return (
        signals.filter(F.col("user").isNotNull() & F.col("item").isNotNull())
        .groupBy("user", "item")
        .agg(F.sum("weight").alias("weight"))
        .filter(F.col("weight").isNotNull())
        .select("user", "item", logistic_scale("weight", logistic_param).alias("weight"))
    )


def item_popularity(ui_weights: DataFrame) -> DataFrame:
    """Popularity of each item = sum of its scaled user weights (all items)."""
    return ui_weights.groupBy("item").agg(F.sum("weight").alias("overall_weight"))


# --------------------------------------------------------------------------- G3, G4
BLOCK_ITEMS = 2048  # items of a user that are paired in one place
TASK_PAIRS = 1 << 22  # pairs that one task makes, and sums up, at about 60 bytes each
ROUND_PAIRS = 1 << 29  # pairs that are on disk at once, at 4 to 16 bytes each
SUM_PAIRS = 1 << 20  # pairs that one task of a round sums
PARTITIONS_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def top_links_per_user(ui_weights: DataFrame, k: int | None, rank_col: str | None = None) -> DataFrame:
    """Each user's ``k`` strongest items (weight desc, item asc).  The cap is
    part of the graph's definition and drops the weaker items of a user;
    ``None`` keeps all, whose quadratic number of pairs `item_pairs` spreads."""
    return top_k(ui_weights, ["user"],
                 [F.desc_nulls_last(sort_key("weight")), F.asc_nulls_last("item")], k, rank_col)


def contract_user_items(ui_top: DataFrame, keep_user: bool = False) -> DataFrame:
    """Every pair of items of one user gives a link term min(w1, w2).

    Only half of the pairs (item_A < item_B) are produced; the weight is
    symmetric, so callers mirror *after* aggregating and thresholding, which
    halves the largest shuffle.  The input comes out of a window partitioned
    by user, so this self-join adds no exchange of its own.  Per user there are
    at most k(k-1)/2 terms because the input is capped by ``top_links_per_user``."""
    a, b = ui_top.alias("a"), ui_top.alias("b")
    cols = [F.col("a.item").alias("item_A"), F.col("b.item").alias("item_B"),
            F.least(F.col("a.weight"), F.col("b.weight")).alias("weight")]
    if keep_user:
        cols.append(F.col("a.user").alias("user"))
    return a.join(b, (F.col("a.user") == F.col("b.user")) & (F.col("a.item") < F.col("b.item"))
                  ).select(*cols)


def contract_in_blocks(ui: DataFrame, keep_user: bool = False, block_items: int = BLOCK_ITEMS, tasks: int | None = None,
                       only: Column | None = None) -> DataFrame:
    """G3 for users with any number of items: the same rows as `contract_user_items`.

    A user's items are dealt by hash into g groups of about ``block_items``.
    Each of the g(g+1)/2 pairs of groups is a join key of its own, so the pairs
    of one user are made in that many places, none of which meets more than two
    groups; an item goes to the g cells of its group.  A user of up to
    ``block_items`` items is one cell.  Beyond that only the numbers of groups
    of such users are joined to their rows (at most one row per ``block_items``
    of the input), and a hot user's rows are split there.  ``tasks`` deals the
    cells to that many tasks (see `pair_tasks`); ``only``, a condition on
    ``item``, leaves the pairs whose item_A fulfils it."""
    many = ui.groupBy("user").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_items).select(
        "user", F.ceil(F.col("n") / block_items).cast("int").alias("groups"))
    groups = F.coalesce(F.col("m.groups"), F.lit(1))
    dealt = splittable_join(ui.alias("u"), many.alias("m"), "u.user", "m.user", "left").select(
        "u.user", "u.item", "u.weight", groups.alias("groups"), F.pmod(F.xxhash64("u.item"), groups).cast("int").alias("own"))
    cells = dealt.select("user", "item", "weight", "own", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("other")).select(
        "user", "item", "weight", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    if tasks:
        cells = cells.repartition(tasks, "user", "x", "y")
    a, b = (cells if only is None else cells.filter(only)).alias("a"), cells.alias("b")
    on = ((F.col("a.user") == F.col("b.user")) & (F.col("a.x") == F.col("b.x")) & (F.col("a.y") == F.col("b.y"))
          & (F.col("a.item") < F.col("b.item")) & ((F.col("a.x") == F.col("a.y")) | (F.col("a.own") != F.col("b.own"))))
    cols = [F.col("a.item").alias("item_A"), F.col("b.item").alias("item_B"),
            F.least(F.col("a.weight"), F.col("b.weight")).alias("weight")]
    return a.join(b, on).select(*cols, *([F.col("a.user").alias("user")] if keep_user else []))


def item_pairs(ui: DataFrame, max_links_per_user: int | None, keep_user: bool = False, block_items: int = BLOCK_ITEMS,
               tasks: int | None = None) -> DataFrame:
    """R1 + G3: pairs of each user's ``max_links_per_user`` strongest items.
    Where that leaves more than ``block_items`` items to a user, pairs are made
    in blocks, in ``tasks`` tasks if given."""
    top = top_links_per_user(ui, max_links_per_user)
    if max_links_per_user is None or max_links_per_user > block_items:
        return contract_in_blocks(top, keep_user, block_items, tasks)
    return contract_user_items(top, keep_user)


def mirror_links(half: DataFrame) -> DataFrame:
    """Both directions of symmetric half links (item_A < item_B).

    One ``explode`` of a two-element array in the same stage as the final
    aggregate: the aggregate is computed once (a union would run it twice)."""
    other = [c for c in half.columns if c not in ("item_A", "item_B")]
    fwd = F.struct(F.col("item_A").alias("a"), F.col("item_B").alias("b"))
    rev = F.struct(F.col("item_B").alias("a"), F.col("item_A").alias("b"))
    return half.select(F.explode(F.array(fwd, rev)).alias("d"), *other).select(
        F.col("d.a").alias("item_A"), F.col("d.b").alias("item_B"), *other)


def filtered_user_items(signals: DataFrame, logistic_param: float, min_link_weight: float):
    """G1 + G2 + item threshold: (ui weights of items with popularity >= min, item_weights)."""
    return popular_user_items(aggregate_signals(signals, logistic_param), min_link_weight)


def popular_user_items(ui: DataFrame, min_link_weight: float) -> tuple[DataFrame, DataFrame]:
    """G2 + item threshold on summed signals."""
    item_weights = item_popularity(ui)
    keep = item_weights.filter(F.col("overall_weight") >= F.lit(float(min_link_weight))).select("item")
    return semi_join_items(ui, keep), item_weights


def semi_join_items(ui: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows of ``ui`` whose item is in ``keep``; a hot item is split over tasks."""
    return splittable_join(ui.alias("u"), keep.select("item").alias("k"), "u.item", "k.item", "left_semi")


def count_pairs(ui: DataFrame, max_links_per_user: int | None) -> int:
    """Pairs of items that `item_pairs` makes of ``ui``, counted when this is called (one number per user)."""
    n = F.count(F.lit(1))
    n = n if max_links_per_user is None else F.least(n, F.lit(max_links_per_user))
    return int(ui.groupBy("user").agg((n * (n - 1) / 2).alias("n")).agg(F.sum("n")).first()[0] or 0)


def pair_tasks(ui: DataFrame, max_links_per_user: int | None, pairs: int | None = None) -> int | None:
    """As many tasks as keep about TASK_PAIRS pairs each; None where they are few.

    The rows of a user are few beside their pairs, so partitions of an even size
    in bytes make ever more pairs as the input grows, which the partial sums
    hold in memory.  The pairs are counted when this is called, unless their number
    is given.  As many partitions are the initial number of the exchange of the
    sums, from which adaptive execution merges small ones; it is raised, never
    lowered."""
    spark = ui.sparkSession
    pairs = count_pairs(ui, max_links_per_user) if pairs is None else pairs
    tasks = -(-pairs // TASK_PAIRS)
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if tasks <= 2:
        return None
    if tasks > int(spark.conf.get(PARTITIONS_CONF, None) or given):
        spark.conf.set(PARTITIONS_CONF, str(tasks))
    return max(tasks, given)


def dealt_by_pairs(ui: DataFrame, max_links_per_user: int) -> DataFrame:
    """``ui`` dealt by user to `pair_tasks` tasks; where these are few, the rows come back as they are."""
    tasks = pair_tasks(ui, max_links_per_user)
    return ui.repartition(tasks, "user") if tasks else ui


def user_lists(ui: DataFrame, max_links_per_user: int) -> DataFrame:
    """R1 as one row per user: (items, weights), arrays of the user's strongest items in ascending order."""
    top = top_links_per_user(ui, max_links_per_user)
    lists = top.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("item", "weight"))).alias("l"))
    return lists.filter(F.size("l") > 1).select(F.col("l.item").alias("items"), F.col("l.weight").alias("weights"))


def sum_listed_pairs(lists: DataFrame, parts: int, only: Column | None = None, hot: DataFrame | None = None) -> DataFrame:
    """G3 and the sums of G4 from `user_lists`: item_A, item_B, weight of the half
    links whose item_A fulfils ``only``, a condition on ``item``.

    An item goes with the list of its user's greater items to the task of its
    key, where the pairs are made and summed: a pair is 16 bytes of a row there
    (12, if items are integers), not a row of its own.  Items of ``hot`` (item) have
    more pairs than a task takes; theirs are made first and go by both items."""
    heads = lists.select("items", "weights", F.posexplode("items").alias("at", "item"))
    if only is not None:
        heads = heads.filter(only)
    greater = lambda values: F.slice(values, F.col("at") + 2, F.size(values))
    rows = heads.filter(F.col("at") + 1 < F.size("items")).select(
        "item", F.col("weights")[F.col("at")].alias("own"), greater("items").alias("others"), greater("weights").alias("theirs"))

    def sums(of: DataFrame) -> DataFrame:
        pairs = of.select(F.col("item").alias("item_A"), "own", "theirs", F.posexplode("others").alias("at", "item_B"))
        return pairs.groupBy("item_A", "item_B").agg(F.sum(F.least("own", F.col("theirs")[F.col("at")])).alias("weight"))

    if hot is None:
        return sums(rows.repartition(parts, "item"))
    usual = splittable_join(rows.alias("r"), hot.alias("h"), "r.item", "h.item", "left_anti")
    few = splittable_join(rows.alias("r"), hot.alias("h"), "r.item", "h.item", "left_semi")
    return sums(usual.repartition(parts, "item")).unionByName(sums(few))


def _narrowed(ui: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``ui`` with long items as integers from their smallest, where these suffice,
    and what turns them back in a table of half links."""
    if isinstance(ui.schema["item"].dataType, T.LongType):
        low, high = ui.agg(F.min("item"), F.max("item")).first()
        if low is not None and high - low < 1 << 31:
            back = lambda half: half.withColumns({c: F.col(c).cast("long") + F.lit(low).cast("long") for c in ("item_A", "item_B")})
            return ui.withColumn("item", (F.col("item") - F.lit(low).cast("long")).cast("int")), back
    return ui, lambda half: half


def summed_pairs(ui: DataFrame, max_links_per_user: int | None, block_items: int, pairs: int, tasks: int, least: float) -> DataFrame:
    """Half links of ``ui``, which has up to ``pairs`` pairs, whose summed weight is
    at least ``least``, written when this is called.

    The pairs are many times the input and most of them are dropped by ``least``.
    They are made and summed in rounds of about ROUND_PAIRS, each for the pairs of
    one share of the items by hash, and a round's shuffle files go before the next.
    The written lists are read in every round; a pair is made in one of them."""
    rounds = max(1, -(-pairs // ROUND_PAIRS))
    only = [None if rounds == 1 else F.pmod(F.xxhash64("item"), F.lit(rounds)) == r for r in range(rounds)]
    kept = lambda half: half.filter(F.col("weight") >= F.lit(float(least)))
    if max_links_per_user is None or max_links_per_user > block_items:
        top = stored(top_links_per_user(ui, max_links_per_user), "user-tops") if max_links_per_user is not None else ui
        return stored_in_parts((kept(contract_in_blocks(top, block_items=block_items, tasks=tasks, only=o)
                                     .groupBy("item_A", "item_B").agg(F.sum("weight").alias("weight"))) for o in only), "pair-sums")
    ui, back = _narrowed(ui)
    lists = stored(user_lists(ui, max_links_per_user), "user-lists")
    own = lists.select(F.size("items").alias("n"), F.explode("items").alias("item")).groupBy("item").agg(F.sum(F.col("n") - 1).alias("n"))
    hot = stored(own.filter(F.col("n") > TASK_PAIRS).select("item"), "hot-items")
    spread = hot if hot.count() else None
    half = stored_in_parts((back(kept(sum_listed_pairs(lists, -(-pairs // (rounds * SUM_PAIRS)), o, spread))) for o in only), "pair-sums")
    discard(lists)
    return half


def build_item_item_graph(signals: DataFrame, logistic_param: float, min_link_weight: float,
                          max_links_per_user: int | None, block_items: int = BLOCK_ITEMS) -> tuple[DataFrame, DataFrame]:
    """(ii_links[item_A, item_B, weight], item_weights[item, overall_weight]).

    The same threshold prunes items (popularity) before pairing and links
    (summed weight) after it.  The popularity table itself is not cut (Q12).
    The summed signals are written and their pairs counted when this is called,
    and so are the links (`summed_pairs`); where the pairs are few, the plan goes
    back to the signals and stays lazy."""
    ui = stored(aggregate_signals(signals, logistic_param), "user-items")
    pairs = count_pairs(ui, max_links_per_user)  # the threshold leaves no more
    tasks = pair_tasks(ui, max_links_per_user, pairs)
    if tasks is None:
        discard(ui)
        ui_filt, item_weights = filtered_user_items(signals, logistic_param, min_link_weight)
        half = (item_pairs(ui_filt, max_links_per_user, block_items=block_items)
                .groupBy("item_A", "item_B").agg(F.sum("weight").alias("weight"))
                .filter(F.col("weight") >= F.lit(float(min_link_weight))))
    else:
        ui_filt, item_weights = popular_user_items(ui, min_link_weight)
        half = summed_pairs(ui_filt, max_links_per_user, block_items, pairs, tasks, min_link_weight)
    return mirror_links(half), item_weights


# --------------------------------------------------------------------------- G5-G7
def _adjust(ii_links: DataFrame, item_weights: DataFrame, numerator, prior: float,
            carry: Sequence[str]) -> DataFrame:
    l, w = ii_links.alias("l"), item_weights.alias("w")
    return splittable_join(l, w, "l.item_B", "w.item").select(
        F.col("l.item_A").alias("item_A"), F.col("l.item_B").alias("item_B"),
        F.try_divide(numerator, F.col("w.overall_weight") + F.lit(float(prior))).alias("weight"),
        F.col("l.weight").alias("raw_weight"),
        *[F.col(f"l.{c}").alias(c) for c in carry])


def bayes_adjust(ii_links: DataFrame, item_weights: DataFrame, prior: float,
                 carry: Sequence[str] = ()) -> DataFrame:
    """Weight / (popularity(item_B) + prior), an estimate of P(A | B);
    keeps the old weight as raw_weight and passes ``carry`` columns through."""
    return _adjust(ii_links, item_weights, F.col("l.weight"), prior, carry)


def boost_adjust(ii_links: DataFrame, item_weights: DataFrame, prior: float,
                 boost: str) -> DataFrame:
    """Weight * f(popularity) / (popularity + prior), f in SQRT / LOG / linear.
    LOG may give weights <= 0 (Q11); they are returned as they are."""
    f = popularity_boost(boost)
    return _adjust(ii_links, item_weights, F.col("l.weight") * f(F.col("w.overall_weight")),
                   prior, ())


def quality_adjust(ii_links: DataFrame, item_weights: DataFrame, item_quality: DataFrame,
                   quality_logistic_param: float, prior: float) -> DataFrame:
    """Weight * logistic(quality(item_B)) / (popularity(item_B) + prior).
    Items without a quality score cannot be targets (inner join, Q19)."""
    w = item_weights.alias("iw").join(
        item_quality.select("item", "quality_score").alias("q"),
        F.col("iw.item") == F.col("q.item")).select(
        F.col("iw.item").alias("item"), F.col("iw.overall_weight").alias("overall_weight"),
        logistic_scale(F.col("q.quality_score"), quality_logistic_param).alias("qm"))
    return _adjust(ii_links, w, F.col("l.weight") * F.col("w.qm"), prior, ())


# --------------------------------------------------------------------------- G8
def add_item_item_signals(ii_links: DataFrame, extra_links: DataFrame, item_weights: DataFrame,
                          missing: str = "zero") -> tuple[DataFrame, DataFrame]:
    """Add extra item-item signals to the graph.

    Popularity of item_A grows by the sum of its extra weights (full outer join,
    negative totals clipped to 0).  ``missing='zero'`` treats an item present on
    one side only as 0 on the other (the stated intent); ``missing='null'``
    reproduces null propagation (Q4).  Links are the union of both sets without
    merging equal pairs (Q6), keeping only weight > 0."""
    if missing not in ("zero", "null"):
        raise ValueError("missing must be 'zero' or 'null'")
    extra = extra_links.select("item_A", "item_B", F.col("weight").cast("double").alias("weight"))
    extra_sum = extra.groupBy(F.col("item_A").alias("item")).agg(
        F.sum("weight").alias("extra_weight"))
    j = item_weights.alias("w").join(extra_sum.alias("e"), F.col("w.item") == F.col("e.item"), "full")
    a, b = F.col("w.overall_weight"), F.col("e.extra_weight")
    total = (F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))) if missing == "zero" else a + b
    weights = j.select(F.coalesce(F.col("w.item"), F.col("e.item")).alias("item"),
                       total.alias("t")).select(
        "item", F.when(F.col("t") < 0, F.lit(0.0)).otherwise(F.col("t")).alias("overall_weight"))
    links = (ii_links.select("item_A", "item_B", "weight").unionByName(extra)
             .filter(F.col("weight") > 0))
    return links, weights


# --------------------------------------------------------------------------- G9-G11
def diversify_links(ii_links: DataFrame, metadata: DataFrame, max_rank: int | None = None) -> DataFrame:
    """Divide each link's weight by its rank among item_A's links whose
    item_B shares the same metadata value.  Links to items without metadata
    drop; several metadata rows per item multiply links (inner join).

    Without ``max_rank`` every link is returned; the ranks are counted over
    ranges of (item, value, weight), so a value that most links share is split
    over tasks (one table is written when this is called).  ``max_rank`` keeps
    only links ranked up to it within their group, through a group-limited
    window (partial limit before the shuffle), for callers that keep at most
    ``max_rank`` links per item anyway (see E5)."""
    l, m = ii_links.alias("l"), metadata.alias("m")
    j = splittable_join(l, m, "l.item_B", "m.item").select(
        "l.item_A", "l.item_B", "l.weight", "l.raw_weight", F.col("m.metadata_field"))
    order = [F.desc_nulls_last(sort_key("weight")), F.asc_nulls_last("item_B")]
    if max_rank is None:
        r = distributed_rank(j, ["item_A", "metadata_field"], order, "feature_rank")
    else:
        r = top_k(j, ["item_A", "metadata_field"], order, max_rank, "feature_rank")
    return r.select("item_A", "item_B", (F.col("weight") / F.col("feature_rank")).alias("weight"),
                    "raw_weight")


# Fixed values that must equal the reference's: the owner pattern of an item id.
OWNER_PATTERN = r"(.*)/.*"


def owner_of(item_col: str = "item_B"):
    """the part of an 'owner/name' id before the last '/', null if there is none."""
    s = F.col(item_col).cast("string")
    return F.when(s.contains("/"), F.regexp_extract(s, OWNER_PATTERN, 1))


def owner_diversity(item_recs: DataFrame) -> DataFrame:
    """Divide a rec's weight by its rank among item_A's recs of the same
    owner, then re-rank all recs of item_A by the new weight (rank from 1)."""
    r = rank_within(item_recs.withColumn("owner", owner_of("item_B")), ["item_A", "owner"],
                    [F.desc_nulls_last(sort_key("weight")), F.asc_nulls_last("item_B")], "owner_rank")
    adj = r.select("item_A", "item_B", (F.col("weight") / F.col("owner_rank")).alias("weight"),
                   "raw_weight")
    return rank_within(adj, ["item_A"],
                       [F.desc_nulls_last(sort_key("weight")), F.asc_nulls_last("item_B")], "rank")


def links_with_metadata(ii_links: DataFrame, metadata: DataFrame) -> DataFrame:
    """Attach metadata of both ends; weights unchanged."""
    l, ma, mb = ii_links.alias("l"), metadata.alias("ma"), metadata.alias("mb")
    return (l.join(ma, F.col("l.item_A") == F.col("ma.item"))
            .join(mb, F.col("l.item_B") == F.col("mb.item"))
            .select("l.item_A", "l.item_B", "l.weight",
                    F.col("ma.metadata_field").alias("metadata_A"),
                    F.col("mb.metadata_field").alias("metadata_B")))
