"""Inspection and clean-up helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cograph.functions.skew import splittable_join


def remove_bots(signals: DataFrame, threshold: int) -> DataFrame:
    """Keep the signals of users with fewer than ``threshold`` signals.

    The per-user count is a partial+final aggregate (a bot's rows collapse on
    the map side); the kept users return through a semi join that can split a
    bot's rows over tasks."""
    counts = signals.groupBy("user").agg(F.count(F.lit(1)).alias("num_signals"))
    normal = counts.filter(F.col("num_signals") < threshold).select("user")
    return splittable_join(signals.alias("s"), normal.alias("n"), "s.user", "n.user", "left_semi").select("user", "item", "weight")


def select_signals(item1, item2, user_signals: DataFrame, only_pair: bool = False) -> DataFrame:
    """All signals (user, item, signal) of the users that have both items,
    ordered by user, item, signal.  ``only_pair`` keeps just the two items."""
    u1 = user_signals.filter(F.col("item") == F.lit(item1)).select("user")
    u2 = user_signals.filter(F.col("item") == F.lit(item2)).select("user")
    users = u1.join(u2, "user", "left_semi").distinct()
    out = user_signals.join(users, "user", "left_semi").select("user", "item", "signal")
    if only_pair:
        out = out.filter(F.col("item").isin(item1, item2))
    return out.orderBy(F.asc_nulls_first("user"), F.asc_nulls_first("item"), F.asc_nulls_first("signal"))


def item_rec_names(item_recs: DataFrame, item_names: DataFrame) -> DataFrame:
    """Names for both items of each item rec (recs of unnamed items drop),
    ordered by item_A, rank."""
    r, nb, na = item_recs.alias("r"), item_names.alias("nb"), item_names.alias("na")
    j = (r.join(nb, F.col("r.item_B") == F.col("nb.id"))
         .join(na, F.col("r.item_A") == F.col("na.id")))
    return j.select(F.col("r.item_A").alias("item_A"), F.col("na.name").alias("item_A_name"),
                    F.col("r.item_B").alias("item_B"), F.col("nb.name").alias("item_B_name"),
                    "r.weight", "r.raw_weight", "r.rank").orderBy(
        F.asc_nulls_first("item_A"), F.asc_nulls_first("rank"))


def user_rec_names(user_recs: DataFrame, user_names: DataFrame, item_names: DataFrame) -> DataFrame:
    """Names for user, item and reason item; an unnamed reason falls back
    to its id, unnamed users and items drop.  Ordered by user, rank."""
    r, nr = user_recs.alias("r"), item_names.alias("nr")
    j1 = r.join(nr, F.col("r.reason_item") == F.col("nr.id"), "left").select(
        "r.*", F.coalesce(F.col("nr.name"), F.col("r.reason_item").cast("string")).alias("reason_item_name"))
    j, ni, nu = j1.alias("j"), item_names.alias("ni"), user_names.alias("nu")
    out = (j.join(ni, F.col("j.item") == F.col("ni.id"))
           .join(nu, F.col("j.user") == F.col("nu.id")))
    return out.select(
        F.col("j.user").alias("user"), F.col("nu.name").alias("user_name"),
        F.col("j.item").alias("item"), F.col("ni.name").alias("item_name"),
        "j.weight", "j.reason_item", "j.reason_item_name", "j.user_reason_item_weight",
        "j.item_reason_item_weight", "j.rank").orderBy(F.asc_nulls_first("user"), F.asc_nulls_first("rank"))
