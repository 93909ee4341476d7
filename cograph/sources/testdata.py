"""Views that map the supplied TPC-H-like tables onto the reference's inputs
(FIXTURES.md: FX1-FX7).  Every view is a lazy DataFrame over the whole tables,
so its work grows with them; their DuckDB twins are in ``cograph.plans.oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def signals_fx1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1 user-item signals: customer -> part of every line item, a returned
    line counts 3, any other 1."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"),
        F.when(F.col("l_returnflag") == "R", F.lit(3.0)).otherwise(F.lit(1.0)).alias("weight"))


def typed_signals_fx2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2 typed signals from the event stream: item = props.k."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("user"),
        F.get_json_object("props", "$.k").cast("int").alias("item"),
        F.col("event_type").alias("signal_type"),
        F.when(F.col("event_type") == "purchase", F.lit(3.0)).otherwise(F.lit(1.0)).alias("weight"))


def event_log_fx3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX3 event log with the reference's nested schema (one row per line item).
    An item is a fork iff its brand number is <= 8."""
    # dealt by the key of the first join: a single large file then keeps all cores busy
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus").repartition("l_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    j = (li.join(o, li["l_orderkey"] == o["o_orderkey"])
         .join(c, F.col("c_custkey") == F.col("o_custkey"))
         .join(p, F.col("p_partkey") == F.col("l_partkey")))
    etype = (F.when(F.col("l_returnflag") == "R", "ForkEvent")
             .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "PullRequestEvent")
             .when(F.col("l_returnflag") == "A", "PushEvent")
             .when(F.col("l_linestatus") == "O", "WatchEvent")
             .otherwise("IssuesEvent"))
    return j.select(
        F.col("c_name").alias("actor"),
        F.struct(
            F.when(F.col("c_custkey") % 2 == 0, F.md5("c_name"))
            .when(F.col("c_custkey") % 3 == 0, F.lit("short")).alias("gravatar_id"),
            F.lit(None).cast("string").alias("company"),
        ).alias("actor_attributes"),
        F.struct(
            F.col("p_brand").alias("owner"),
            F.when(F.col("p_name") == "cold rod", F.lit("Spoon-Knife")).otherwise(F.col("p_name")).alias("name"),
            F.when(F.substring("p_brand", 7, 1000).cast("int") <= 8, F.lit("true"))
            .otherwise(F.lit("false")).alias("fork"),
            F.when(F.col("p_type") == "PROMO", F.lit(None)).otherwise(F.col("p_type")).alias("language"),
            F.concat(F.lit("about "), F.col("p_name"), F.lit(" "), F.repeat(F.lit("x"), 120)).alias("description"),
            (F.col("p_size") * 4).cast("int").alias("stargazers"),
            F.col("p_size").cast("int").alias("forks"),
        ).alias("repository"),
        etype.alias("type"),
        F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
    )


def feature_metadata_fx4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4 (item, metadata_field) = (part, brand)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_brand").alias("metadata_field"))


def item_item_signals_fx5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX5 extra item-item signals: each line of an order -> the next one,
    negative for a high discount on the first of the two."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_discount")
    x, y = li.alias("x"), li.alias("y")
    return x.join(y, (F.col("x.l_orderkey") == F.col("y.l_orderkey"))
                  & (F.col("x.l_linenumber") + 1 == F.col("y.l_linenumber"))).filter(
        F.col("x.l_partkey") != F.col("y.l_partkey")).select(
        F.col("x.l_partkey").alias("item_A"), F.col("y.l_partkey").alias("item_B"),
        F.when(F.col("x.l_discount") >= 0.08, F.lit(-1.0)).otherwise(F.lit(2.0)).alias("weight"))


def source_items_fx6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_size") <= 40).select(
        F.col("p_partkey").alias("item"))


def dest_items_fx6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_type") != "ECONOMY").select(
        F.col("p_partkey").alias("item"))


def item_names_fx7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX7 item names."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def user_names_fx7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
