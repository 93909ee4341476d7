"""Connected components of a link table, without collecting links or nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cograph.functions.skew import salted_join
from cograph.llm.common import scratch_table
from cograph.session import discard


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of ``links`` (a long, b long); component is the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014), each
    written to the shared folder.  A hub with a third of all links is met by a
    partial minimum and a salted join, never as one group.  Links with a null
    end and self links are ignored; an empty table gives an empty table.
    """
    edges = scratch_table(
        links.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen, first = mark(edges), edges
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = salted_join(both, least, "u", hint="merge").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch_table(large.filter("u <> v"), "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(large, least, "u", hint="merge").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        old, edges = edges, scratch_table(small.filter("u <> v").distinct(), "cc-small")
        discard(large)
        if old is not first:  # the nodes are read from it
            discard(old)
        before, seen = seen, mark(edges)
        if seen == before:
            break
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))
