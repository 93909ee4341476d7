"""Entry-point recommenders.

Each is one function, DataFrames in, DataFrame(s) out, parameters from
``RecParams``.  Everything stays lazy; the caller decides what to write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cograph.operators import detailed as D
from cograph.operators import graph as G
from cograph.operators import neighbours as N
from cograph.operators import users as U
from cograph.params import RecParams


def _graph(signals: DataFrame, p: RecParams):
    return G.build_item_item_graph(signals, p.logistic_param, p.min_link_weight,
                                   p.max_links_per_user)


def _fills(p: RecParams) -> bool:
    """Whether an item's direct neighbours can fill its list."""
    return p.initial_nhood_size is None or p.initial_nhood_size >= p.num_recs_per_item


def item_item_recs(signals: DataFrame, p: RecParams = RecParams()) -> DataFrame:
    """G4 -> G5 -> N2.  A neighbourhood larger than the list (or without
    limit) is expanded only as far as the list reaches."""
    links, weights = _graph(signals, p)
    adj = G.bayes_adjust(links, weights, p.prior)
    wide = p.initial_nhood_size is None or p.initial_nhood_size > p.num_recs_per_item
    return N.two_hop_neighbours(adj, p.initial_nhood_size, p.num_recs_per_item, bounded=wide)


def user_item_recs(signals: DataFrame, item_recs: DataFrame, p: RecParams = RecParams()) -> DataFrame:
    """V3 with the user list length and diversity flag of ``p``."""
    return U.build_user_recs(signals, item_recs, p.num_recs_per_user, p.diversity_adjust)


def item_item_recs_detailed(typed_signals: DataFrame, p: RecParams = RecParams()) -> DataFrame:
    """G12 -> G13 -> N5; adds link_data (direct recs) and linking_item (indirect)."""
    links, weights = D.build_item_item_graph_detailed(
        typed_signals, p.logistic_param, p.min_link_weight, p.max_links_per_user)
    adj = G.bayes_adjust(links, weights, p.prior, carry=["link_data"])
    return N.two_hop_neighbours(adj, p.initial_nhood_size, p.num_recs_per_item,
                                carry=["link_data"], with_linking_item=True)


def item_item_recs_add_item_item(signals: DataFrame, item_item_signals: DataFrame,
                                 p: RecParams = RecParams(), missing: str = "zero") -> DataFrame:
    """G4 -> G8 -> G5 -> N2 -> keep complete rows only (P14: direct recs, Q5).
    Where the neighbourhood can fill the list, no path beyond it is ranked; links
    may repeat after G8."""
    links, weights = _graph(signals, p)
    links2, weights2 = G.add_item_item_signals(links, item_item_signals, weights, missing)
    adj = G.bayes_adjust(links2, weights2, p.prior)
    recs = N.two_hop_neighbours(adj, p.initial_nhood_size, p.num_recs_per_item, bounded=_fills(p), repeats=True)
    return recs.dropna(subset=["item_A", "item_B", "weight", "raw_weight", "rank"])


def item_item_recs_diversified(signals: DataFrame, metadata: DataFrame,
                               p: RecParams = RecParams()) -> DataFrame:
    """E5: G4 -> G5 -> G9 -> N2.

    N2 keeps each item's ``initial_nhood_size`` nearest links, and a link
    ranked r within its (item_A, metadata) group is beaten by the r - 1 links
    above it: w_j / j exceeds w_r / r for j < r by a factor of r / (r - 1) at
    least, far more than orderings round away.  So G9 only needs to rank up to
    nhood per group: a group-limited window, whatever the group size."""
    links, weights = _graph(signals, p)
    adj = G.diversify_links(G.bayes_adjust(links, weights, p.prior), metadata,
                            max_rank=p.initial_nhood_size)
    return N.two_hop_neighbours(adj, p.initial_nhood_size, p.num_recs_per_item)


def item_item_recs_available(signals: DataFrame, source_items: DataFrame, dest_items: DataFrame,
                             p: RecParams = RecParams()) -> DataFrame:
    """G4 -> G5 -> N4."""
    links, weights = _graph(signals, p)
    adj = G.bayes_adjust(links, weights, p.prior)
    return N.available_neighbours(adj, source_items, dest_items, p.initial_nhood_size,
                                  p.num_recs_per_item)


def item_item_recs_popularity_boost(signals: DataFrame, p: RecParams = RecParams(),
                                    boost: str = "SQRT") -> DataFrame:
    """G4 -> G6 -> N2.  Where the neighbourhood can fill the list, no path
    beyond it can be in the list, and none is ranked."""
    links, weights = _graph(signals, p)
    adj = G.boost_adjust(links, weights, p.prior, boost)
    return N.two_hop_neighbours(adj, p.initial_nhood_size, p.num_recs_per_item, bounded=_fills(p))


def quality_item_graph(interest_signals: DataFrame, item_quality: DataFrame,
                       p: RecParams = RecParams.application()) -> DataFrame:
    """E8 (graph part): G4 -> G7 -> N1 -> G10.  Returns the item-item graph
    item_A, item_B, weight, raw_weight, rank."""
    links, weights = _graph(interest_signals, p)
    adj = G.quality_adjust(links, weights, item_quality, p.quality_logistic_param, p.prior)
    return G.owner_diversity(N.direct_neighbours(adj, p.num_recs_per_item))


def item_recs_output(item_graph: DataFrame, item_metadata: DataFrame) -> DataFrame:
    """E8 (output part, J20 + R8): item, rank, rec, language, num_forks,
    num_stars, description; recs of items without metadata drop.  Rows of one
    item are gathered in one partition and ordered by rank there (R8), with no
    global sort."""
    g, m = item_graph.alias("g"), item_metadata.alias("m")
    out = g.join(m, F.col("g.item_B") == F.col("m.item")).select(
        F.col("g.item_A").alias("item"), F.col("g.rank").alias("rank"),
        F.col("g.item_B").alias("rec"), "m.language", "m.num_forks", "m.num_stars",
        "m.description")
    return out.repartition("item").sortWithinPartitions("item", "rank")


def both_channels(contrib_signals: DataFrame, interest_signals: DataFrame) -> DataFrame:
    """Signals of both tracks with their channel number, 1 and 2."""
    return contrib_signals.withColumn("channel", F.lit(1)).unionByName(interest_signals.withColumn("channel", F.lit(2)))


def deduped_channels(signals: DataFrame, item_graph: DataFrame, p: RecParams = RecParams.application(),
                     prefer: str = "worst") -> DataFrame:
    """E9, first part: V3 for both channels in one pass, then V4.
    ``signals`` have a channel column (see `both_channels`); ``item_graph`` is
    counted and the summed signals are written when this is called."""
    recs = U.build_user_recs_in_place(signals, item_graph, p.num_recs_per_user, p.num_recs_per_item, p.diversity_adjust, by=["channel"])
    return U.dedupe_channels(recs, prefer)


def channel_outputs(deduped: DataFrame, signals: DataFrame, item_metadata: DataFrame) -> DataFrame:
    """E9, second part: V5 -> V6 for both channels; channel and the output columns."""
    return U.postprocess_recs(U.recs_with_fork_flag(deduped, signals, by=["channel"]), item_metadata, by=["channel"])


def channel_recs(contrib_signals: DataFrame, interest_signals: DataFrame, item_graph: DataFrame,
                 item_metadata: DataFrame, p: RecParams = RecParams.application(),
                 prefer: str = "worst") -> tuple[DataFrame, DataFrame]:
    """Two channels of user recs (contributions, interests): V3 -> V4 -> V5
    -> V6, both channels in one plan.  Returns (contrib_recs, interest_recs)
    with columns user, rank, item, reason_item, mapped_from_fork, num_forks,
    num_stars, language, description; a caller that wants both writes
    `channel_outputs` once and splits what it wrote."""
    signals = both_channels(contrib_signals, interest_signals)
    both = channel_outputs(deduped_channels(signals, item_graph, p, prefer), signals, item_metadata)
    return U.split_channel(both, 1), U.split_channel(both, 2)
