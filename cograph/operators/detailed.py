"""Detailed variants: links that also tell which signal
types formed them.

Inside the engine the signal counts travel in long form (one row per signal
type), and only the API edge builds ``map<string, bigint>`` columns, because
maps cannot be grouped, compared or de-duplicated in Spark.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cograph.functions.bitmap import prefilter
from cograph.functions.scale import logistic_scale
from cograph.operators.graph import item_pairs, item_popularity, mirror_links, semi_join_items
from cograph.session import stored

# Fixed values that must equal the reference's: the reserved link_data key
# holding the number of users behind a link (it overrides a signal type of that name, Q15).
NUM_USERS = "NUM_USERS"


def _valid_type(c):
    return c.isNotNull() & (c != F.lit(""))


def signal_type_counts(typed_signals: DataFrame) -> DataFrame:
    """A10 (long form): user, item, signal_type, cnt; null or empty types skipped."""
    return (typed_signals.filter(F.col("user").isNotNull() & F.col("item").isNotNull()
                                 & _valid_type(F.col("signal_type")))
            .groupBy("user", "item", "signal_type").agg(F.count(F.lit(1)).alias("cnt")))


def signal_type_map(typed_signals: DataFrame) -> DataFrame:
    """A10: user, item, signal_types map<type, count> (empty map if no typed signal)."""
    counts = (typed_signals.filter(F.col("user").isNotNull() & F.col("item").isNotNull())
              .groupBy("user", "item", "signal_type").agg(F.count(F.lit(1)).alias("cnt")))
    entry = F.when(_valid_type(F.col("signal_type")), F.struct("signal_type", "cnt"))
    return counts.groupBy("user", "item").agg(
        F.map_from_entries(F.collect_list(entry)).alias("signal_types"))


def merge_signal_maps(df: DataFrame, keys: Sequence[str], map_col: str,
                      out_col: str = "signal_types") -> DataFrame:
    """Add count maps key-wise over each group of ``keys``.

    explode -> sum per (keys, map key) (partial aggregation) -> rebuild the map;
    the rebuilt map per group holds one entry per distinct map key."""
    ex = df.select(*keys, F.explode(map_col).alias("k", "v"))
    summed = ex.groupBy(*keys, "k").agg(F.sum("v").alias("v"))
    return summed.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias(out_col))


def link_data_long(links: DataFrame, map_col: str = "link_data",
                   keys: Sequence[str] = ("item_A", "item_B")) -> DataFrame:
    """A map column back to long form: keys, signal, cnt."""
    return links.select(*keys, F.explode(map_col).alias("signal", "cnt"))


def build_item_item_graph_detailed(typed_signals: DataFrame, logistic_param: float,
                                   min_link_weight: float, max_links_per_user: int | None
                                   ) -> tuple[DataFrame, DataFrame]:
    """G4 plus ``link_data`` per link: for every signal type the number of
    such signals the contributing users had on either item, and NUM_USERS, the
    number of users that formed the link.

    Returns (ii_links[item_A, item_B, weight, link_data], item_weights); the
    kept links are written when this is called."""
    sig = typed_signals.filter(F.col("user").isNotNull() & F.col("item").isNotNull())
    # one partial+final aggregate per (user, item, type); the type domain is small
    per_type = sig.groupBy("user", "item", "signal_type").agg(
        F.sum("weight").alias("w"), F.count(F.lit(1)).alias("cnt"))
    typed = _valid_type(F.col("signal_type")) & (F.col("signal_type") != F.lit(NUM_USERS))
    ui = (per_type.groupBy("user", "item")
          .agg(F.sum("w").alias("w"))
          .filter(F.col("w").isNotNull())
          .select("user", "item", logistic_scale("w", logistic_param).alias("weight")))
    item_weights = item_popularity(ui)
    keep = item_weights.filter(F.col("overall_weight") >= F.lit(float(min_link_weight))).select("item")
    # Weights first: of the many pairs only those of links that pass the
    # threshold go on to have their signals counted.
    pairs = item_pairs(semi_join_items(ui, keep), max_links_per_user, keep_user=True)
    half = (pairs.groupBy("item_A", "item_B")
            .agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("num_users"))
            .filter(F.col("weight") >= F.lit(float(min_link_weight))))
    half = stored(half, "detailed-links")
    # of the pairs that are no part of a kept link, a bitmap of the links stops most before they are shuffled
    ends = ["item_A", "item_B"]
    kept = prefilter(pairs.select("user", *ends), half, ends).join(half.select(*ends), ends)
    ends = kept.select("user", "item_A", "item_B", F.explode(F.array("item_A", "item_B")).alias("item"))
    counts = per_type.filter(typed & F.col("user").isNotNull()).select("user", "item", "signal_type", "cnt")
    long = (ends.join(counts, ["user", "item"])
            .groupBy("item_A", "item_B", F.col("signal_type").alias("s")).agg(F.sum("cnt").alias("c"))
            .union(half.select("item_A", "item_B", F.lit(NUM_USERS).alias("s"), F.col("num_users").alias("c"))))
    # one entry per signal type of the link
    data = long.groupBy("item_A", "item_B").agg(F.map_from_entries(F.collect_list(F.struct("s", "c"))).alias("link_data"))
    links = half.select("item_A", "item_B", "weight").join(data, ["item_A", "item_B"])
    return mirror_links(links), item_weights
