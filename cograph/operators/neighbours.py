"""Neighbour ranking operators.

Output (ItemItemRec): item_A, item_B, weight, raw_weight, rank
(raw_weight is null when the best path to item_B is indirect).

Distance is 1 / weight.  The two-hop search keeps each item's ``nhood``
nearest direct neighbours, so every item_A has at most nhood direct and
nhood^2 two-hop candidates; the work per key is bounded no matter how skewed
the input graph is.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cograph.functions.bitmap import prefilter, unsent
from cograph.functions.ranking import top_k
from cograph.functions.scale import sort_key
from cograph.functions.skew import splittable_join


def _nearest():
    return [F.asc_nulls_last(sort_key("dist")), F.asc_nulls_last("item_B")]


def direct_neighbours(ii_links: DataFrame, num_recs: int) -> DataFrame:
    """Top ``num_recs`` links of each item_A by weight, ranked from 1."""
    return top_k(ii_links.select("item_A", "item_B", "weight", "raw_weight"), ["item_A"],
                 [F.desc_nulls_last(sort_key("weight")), F.asc_nulls_last("item_B")],
                 num_recs, "rank")


def _pruned_graph(ii_links: DataFrame, nhood: int | None, carry: Sequence[str]) -> DataFrame:
    """Distance graph pruned to each item's ``nhood`` nearest neighbours
    (``None``: not pruned, but ranked; then the work per item is no longer bounded).
    Links with weight <= 0 or null have no finite distance and are dropped (Q11);
    links with a null end are dropped too.  The explicit not-null filters make
    every reader of this graph carry the same filters (the optimizer would
    otherwise infer them on one join side only), so its exchange is shared."""
    usable = (F.col("weight") > 0) & F.col("item_A").isNotNull() & F.col("item_B").isNotNull()
    dm = ii_links.filter(usable).select(
        "item_A", "item_B", (F.lit(1.0) / F.col("weight")).alias("dist"), "raw_weight", *carry)
    return top_k(dm, ["item_A"], _nearest(), nhood, "hop_rank")


def _best_paths(graph: DataFrame, hop_targets: DataFrame, num_recs: int,
                carry: Sequence[str], dest_items: DataFrame | None,
                with_linking_item: bool) -> DataFrame:
    """Direct edges of ``graph`` and two-hop paths graph -> hop_targets, the
    shortest path per (item_A, item_B), then the top ``num_recs`` per item_A.

    One left outer join of the pruned graph with its continuation yields both
    kinds of candidate: a joined row contributes the two-hop path when a
    continuation exists, and the row of the first continuation (or the lone
    row) also contributes the first hop as a direct edge, so each direct edge
    appears once.  This stands for the reference's join with zero-length self
    loops without building them, and keeps the pruned graph to two readers,
    whose identical projections (the ``tie`` column references every field)
    let Spark compute it once and reuse the exchange.  ``tie`` is a last
    tie-break that never decides anything:
    (item_A, item_B, mid) already identifies a path."""
    bounded = "bound" in graph.columns
    g, h = graph.alias("g"), hop_targets.alias("h")
    # an item that very many others point at (a hub) is split over tasks
    j = splittable_join(g, h, "g.item_B", "h.item_A", "left")
    if bounded:  # a path beyond the bound is none; with the first continuation its first hop goes on as a direct edge
        near = F.coalesce(sort_key(F.col("g.dist") + F.col("h.dist")) <= sort_key("g.bound"), F.lit(True))
        j = j.filter(F.col("h.item_A").isNull() | (F.col("h.hop_rank") == 1) | near)

    def parts(side):
        return ([F.col(f"{side}.raw_weight"), F.col(f"{side}.hop_rank")]
                + [F.col(f"{side}.{c}").isNull() for c in carry])

    tie = F.struct(*[x.alias(f"t{i}") for i, x in enumerate(parts("g") + parts("h"))])
    tie_type = j.select(tie.alias("tie")).schema["tie"].dataType
    key_type = graph.schema["item_A"].dataType
    direct = F.struct(
        F.col("g.item_A").alias("item_A"), F.col("g.item_B").alias("item_B"), F.col("g.dist").alias("dist"),
        F.col("g.raw_weight").alias("raw_weight"), *[F.col(f"g.{c}").alias(c) for c in carry],
        F.lit(None).cast(key_type).alias("mid"), F.lit(0).alias("indirect"), F.lit(None).cast(tie_type).alias("tie"))
    two = F.when(F.col("h.item_A").isNotNull() & near if bounded else F.col("h.item_A").isNotNull(), F.struct(
        F.col("g.item_A").alias("item_A"), F.col("h.item_B").alias("item_B"),
        (F.col("g.dist") + F.col("h.dist")).alias("dist"), F.lit(None).cast("double").alias("raw_weight"),
        *[F.lit(None).cast(graph.schema[c].dataType).alias(c) for c in carry],
        F.col("g.item_B").alias("mid"), F.lit(1).alias("indirect"), tie.alias("tie")))
    # the direct edge is emitted once: with the first continuation, or alone
    first = F.col("h.item_A").isNull() | (F.col("h.hop_rank") == 1)
    cand = (j.select(F.explode(F.array(F.when(first, direct), two)).alias("c")).filter(F.col("c").isNotNull())
            .select("c.*").filter(F.col("item_A") != F.col("item_B")))
    if dest_items is not None:
        cand = prefilter(cand, dest_items, ["item_B"], ["item"])
        dest_items = unsent(dest_items)
        cand = cand.join(dest_items, cand["item_B"] == dest_items["item"], "left_semi")
    # Candidates per item_A are bounded (nhood + nhood^2), so one exchange by
    # item_A serves both the per-pair arg-min and the per-item top-N windows.
    cand = cand.repartition("item_A")
    flat = top_k(cand, ["item_A", "item_B"],
                 [F.asc_nulls_last(sort_key("dist")), F.asc("indirect"), F.asc_nulls_first("mid"),
                  F.asc_nulls_first(sort_key("raw_weight")), F.asc_nulls_first("tie")], 1)
    ranked = top_k(flat, ["item_A"], _nearest(), num_recs, "rank")
    out = [F.col("item_A"), F.col("item_B"), (F.lit(1.0) / F.col("dist")).alias("weight"),
           F.col("raw_weight"), F.col("rank")] + [F.col(c) for c in carry]
    if with_linking_item:
        out.append(F.col("mid").alias("linking_item"))
    return ranked.select(*out)


def _bounded(graph: DataFrame, num_recs: int, repeats: bool = False) -> DataFrame:
    """The distance graph with ``bound``: the distance of item_A's
    ``num_recs``-th nearest other item, null if it has fewer.  That many direct
    edges are at least as near, so no path beyond it can be among the nearest
    ``num_recs``.  A (item_A, item_B) pair must occur once, unless ``repeats``:
    then an item counts at the nearest of its edges."""
    own = Window.partitionBy("item_A")
    other = F.col("item_A") != F.col("item_B")
    if repeats:
        first = F.row_number().over(Window.partitionBy("item_A", "item_B").orderBy("hop_rank")) == 1
        marked = graph.withColumn("__new", (first & other).cast("int"))
        marked = marked.withColumn("__nth", F.sum("__new").over(own.orderBy("hop_rank").rowsBetween(Window.unboundedPreceding, 0)))
        nth = F.max(F.when((F.col("__new") == 1) & (F.col("__nth") == num_recs), F.col("dist"))).over(own)
        return marked.withColumn("bound", nth).drop("__new", "__nth")
    marked = graph.withColumn("__self", F.max((~other).cast("int")).over(own))
    nth = F.max(F.when(F.col("hop_rank") == F.lit(num_recs) + F.col("__self"), F.col("dist"))).over(own)
    return marked.withColumn("bound", nth).drop("__self")


def two_hop_neighbours(ii_links: DataFrame, nhood: int | None, num_recs: int,
                       carry: Sequence[str] = (), with_linking_item: bool = False, bounded: bool = False,
                       repeats: bool = False) -> DataFrame:
    """N2 (and N5 with ``carry=['link_data'], with_linking_item=True``): best
    recommendations among the 2-neighbourhood of each item, distance = 1/weight,
    a path through an intermediate item may beat a weak direct link.

    ``bounded`` gives the same recommendations from fewer candidates, for an
    ``nhood`` of at least ``num_recs`` or none: continuations that lead beyond the distance of
    item_A's ``num_recs``-th nearest neighbour are dropped in the join, before
    the candidates are shuffled and ranked.  It needs links without repeated
    (item_A, item_B) pairs, or ``repeats``."""
    graph = _pruned_graph(ii_links, nhood, carry)
    return _best_paths(_bounded(graph, num_recs, repeats) if bounded else graph, graph, num_recs, carry, None, with_linking_item)


def candidate_rows(ii_links: DataFrame, nhood: int | None, num_recs: int) -> DataFrame:
    """(bounded, rows): two-hop paths that the search ranks, without and with the bound."""
    graph = _pruned_graph(ii_links, nhood, ())
    g, h = _bounded(graph, num_recs).alias("g"), graph.alias("h")
    j = splittable_join(g, h, "g.item_B", "h.item_A").select(F.coalesce(sort_key(F.col("g.dist") + F.col("h.dist")) <= sort_key("g.bound"), F.lit(True)).alias("near"))
    counts = j.agg(F.count(F.lit(1)).alias("a"), F.count(F.when(F.col("near"), 1)).alias("b"))
    return counts.select(F.inline(F.array(F.struct(F.lit(False).alias("bounded"), F.col("a").alias("rows")), F.struct(F.lit(True).alias("bounded"), F.col("b").alias("rows")))))


def available_neighbours(ii_links: DataFrame, source_items: DataFrame, dest_items: DataFrame,
                         nhood: int, num_recs: int) -> DataFrame:
    """Like N2, but only items in ``source_items`` get recs and only items
    in ``dest_items`` are recommended; the middle item of a path is free.
    Pruning to ``nhood`` happens before both restrictions."""
    graph_all = _pruned_graph(ii_links, nhood, ())
    src = unsent(source_items.select("item"))
    dst = dest_items.select("item")
    graph = graph_all.join(src, graph_all["item_A"] == src["item"], "left_semi")
    return _best_paths(graph, graph_all, num_recs, (), dst, False)
