"""Named queries over the supplied tables: Spark callables and DuckDB twins.

``SPARK[name](spark, sf_dir) -> DataFrame`` and ``SQL[name] -> str`` (absent
for queries that are checked on row counts only).  Output doubles have the same
number of significant bits on both sides, so that last-digit noise of parallel
sums does not count as a difference and small values stay visible.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cograph.functions.scale import SHOWN_BITS, fit_logistic_param, logistic_inverse, logistic_scale, significant
from cograph.operators import detailed as D
from cograph.operators import events as E
from cograph.operators import graph as G
from cograph.operators import inspect as X
from cograph.operators import neighbours as N
from cograph.operators import stats as S
from cograph.operators import users as U
from cograph.plans import incremental as INC
from cograph.plans import oracle_sql as Q
from cograph.plans import pipeline as P
from cograph.plans import recommenders as R
from cograph.plans.settings import (BOT_THRESHOLD, FX1, FX2, FX3, N2_NHOOD, N2_RECS, N4_NHOOD, QUALITY_Q,
                                    QUALITY_Y, SELECT_ITEMS, TOP_K_QUERY, UNCAPPED_BLOCK, WIDE_NHOOD, WIDE_RECS, fx2)
from cograph.sources import io as IO
from cograph.sources import keyed_sink as KS
from cograph.sources import testdata as TD
from cograph.session import scratch_folder, stored

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _present(df: DataFrame) -> DataFrame:
    cols = [significant(f.name, SHOWN_BITS).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    def deco(fn):
        SPARK[name] = lambda spark, sf_dir: _present(fn(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _s(x: str) -> str:
    return Q.shown(x, SHOWN_BITS)


def _sel(cols: list[str], src: str, doubles: tuple[str, ...] = ()) -> str:
    out = [f"{_s(c)} AS {c.split('.')[-1]}" if c.split('.')[-1] in doubles else c
           for c in cols]
    return f"SELECT {', '.join(out)} FROM {src}"


APPROX_ACCURACY = 1000
U_ = '"user"'
REC_COLS = ["item_A", "item_B", "weight", "raw_weight", "rank"]
UREC_COLS = [U_, "item", "weight", "reason_item", "user_reason_item_weight", "item_reason_item_weight", "rank"]
UREC_D = ("weight", "user_reason_item_weight", "item_reason_item_weight")


# ============================================================================ FX1 family
def _fx1(spark, d):
    return TD.signals_fx1(spark, d)


def _graph1(spark, d):
    return G.build_item_item_graph(_fx1(spark, d), FX1.logistic_param, FX1.min_link_weight,
                                   FX1.max_links_per_user)


def _bayes1(spark, d):
    links, w = _graph1(spark, d)
    return G.bayes_adjust(links, w, FX1.prior)


def _recs1(spark, d):
    return R.item_item_recs(_fx1(spark, d), FX1)


_G4_1 = [Q.SIG_FX1] + Q.g4(FX1)


@query("user_item_weights", Q._with([Q.SIG_FX1] + Q.g1(FX1.logistic_param),
                                    _sel([U_, "item", "weight"], "ui", ("weight",))))
def q_user_item_weights(spark, d):
    return G.aggregate_signals(_fx1(spark, d), FX1.logistic_param)


@query("item_weights", Q._with([Q.SIG_FX1] + Q.g1(FX1.logistic_param) + Q.g2(),
                               _sel(["item", "overall_weight"], "iw", ("overall_weight",))))
def q_item_weights(spark, d):
    return G.item_popularity(G.aggregate_signals(_fx1(spark, d), FX1.logistic_param))


@query("top_links_per_user", Q._with(
    [Q.SIG_FX1] + Q.g1(FX1.logistic_param) + Q.g2() + Q.ui_filtered(FX1.min_link_weight) + Q.top_users(TOP_K_QUERY),
    _sel([U_, "item", "weight", "CAST(urank AS INTEGER) AS rank"], "top", ("weight",))))
def q_top_links(spark, d):
    ui, _ = G.filtered_user_items(_fx1(spark, d), FX1.logistic_param, FX1.min_link_weight)
    return G.top_links_per_user(ui, TOP_K_QUERY, "rank")


@query("item_item_graph", Q._with(_G4_1, _sel(["item_A", "item_B", "weight"], "links", ("weight",))))
def q_item_item_graph(spark, d):
    return _graph1(spark, d)[0]


@query("item_item_graph_uncapped", Q._with([Q.SIG_FX1] + Q.g4(FX1.with_(max_links_per_user=None)),
                                           _sel(["item_A", "item_B", "weight"], "links", ("weight",))))
def q_item_item_graph_uncapped(spark, d):
    """G3 without the cap: all pairs of all items of a user, made in blocks."""
    return G.build_item_item_graph(_fx1(spark, d), FX1.logistic_param, FX1.min_link_weight, None, UNCAPPED_BLOCK)[0]


@query("graph_bayes", Q._with(_G4_1 + Q.g5(FX1.prior),
                              _sel(["item_A", "item_B", "weight", "raw_weight"], "adj", ("weight", "raw_weight"))))
def q_graph_bayes(spark, d):
    return _bayes1(spark, d)


def _boost(name, fn):
    @query(f"graph_boost_{name}", Q._with(_G4_1 + Q.g6(FX1.prior, fn),
                                          _sel(["item_A", "item_B", "weight", "raw_weight"], "adj",
                                               ("weight", "raw_weight"))))
    def q(spark, d):
        links, w = _graph1(spark, d)
        return G.boost_adjust(links, w, FX1.prior, fn)
    return q


for _n, _f in (("sqrt", "SQRT"), ("log", "LOG"), ("linear", "")):
    _boost(_n, _f)


@query("neighbours_direct", Q._with(_G4_1 + Q.g5(FX1.prior) + Q.n1(FX1.num_recs_per_item),
                                    _sel(REC_COLS, "recs", ("weight", "raw_weight"))))
def q_neighbours_direct(spark, d):
    return N.direct_neighbours(_bayes1(spark, d), FX1.num_recs_per_item)


@query("neighbours_two_hop", Q._with(_G4_1 + Q.g5(FX1.prior) + Q.n2(N2_NHOOD, N2_RECS),
                                     _sel(REC_COLS, "recs", ("weight", "raw_weight"))))
def q_neighbours_two_hop(spark, d):
    return N.two_hop_neighbours(_bayes1(spark, d), N2_NHOOD, N2_RECS)


@query("rec_item_item_wide", Q._with(_G4_1 + Q.g5(FX1.prior) + Q.n2(WIDE_NHOOD, WIDE_RECS),
                                     _sel(REC_COLS, "recs", ("weight", "raw_weight"))))
def q_rec_item_item_wide(spark, d):
    """E1 with a neighbourhood far larger than the list: paths are followed as far as the list reaches."""
    return R.item_item_recs(_fx1(spark, d), FX1.with_(initial_nhood_size=WIDE_NHOOD, num_recs_per_item=WIDE_RECS))


@query("rec_item_item", Q._with(_G4_1 + Q.g5(FX1.prior) + Q.n2(FX1.initial_nhood_size, FX1.num_recs_per_item),
                                _sel(REC_COLS, "recs", ("weight", "raw_weight"))))
def q_rec_item_item(spark, d):
    return _recs1(spark, d)


@query("neighbours_available", Q._with(
    _G4_1 + [Q.SRC_FX6, Q.DST_FX6] + Q.g5(FX1.prior) + Q.n4(N4_NHOOD, FX1.num_recs_per_item),
    _sel(REC_COLS, "recs", ("weight", "raw_weight"))))
def q_neighbours_available(spark, d):
    return N.available_neighbours(_bayes1(spark, d), TD.source_items_fx6(spark, d), TD.dest_items_fx6(spark, d),
                                  N4_NHOOD, FX1.num_recs_per_item)


@query("rec_available", Q._with(
    _G4_1 + [Q.SRC_FX6, Q.DST_FX6] + Q.g5(FX1.prior) + Q.n4(FX1.initial_nhood_size, FX1.num_recs_per_item),
    _sel(REC_COLS, "recs", ("weight", "raw_weight"))))
def q_rec_available(spark, d):
    return R.item_item_recs_available(_fx1(spark, d), TD.source_items_fx6(spark, d), TD.dest_items_fx6(spark, d), FX1)


@query("rec_popularity_boost", Q._with(
    _G4_1 + Q.g6(FX1.prior, "SQRT") + Q.n2(FX1.initial_nhood_size, FX1.num_recs_per_item),
    _sel(REC_COLS, "recs", ("weight", "raw_weight"))))
def q_rec_popularity_boost(spark, d):
    return R.item_item_recs_popularity_boost(_fx1(spark, d), FX1, "SQRT")


@query("diversify_links", Q._with(_G4_1 + [Q.META_FX4] + Q.g5(FX1.prior) + Q.g9(),
                                  _sel(["item_A", "item_B", "weight", "raw_weight"], "dadj",
                                       ("weight", "raw_weight"))))
def q_diversify_links(spark, d):
    return G.diversify_links(_bayes1(spark, d), TD.feature_metadata_fx4(spark, d))


@query("rec_diversify", Q._with(
    _G4_1 + [Q.META_FX4] + Q.g5(FX1.prior) + Q.g9() + Q.n2(FX1.initial_nhood_size, FX1.num_recs_per_item, "dadj"),
    _sel(REC_COLS, "recs", ("weight", "raw_weight"))))
def q_rec_diversify(spark, d):
    return R.item_item_recs_diversified(_fx1(spark, d), TD.feature_metadata_fx4(spark, d), FX1)


@query("links_with_metadata", Q._with(
    _G4_1 + [Q.META_FX4],
    f"SELECT l.item_A, l.item_B, {_s('l.weight')} AS weight, ma.metadata_field AS metadata_A, "
    "mb.metadata_field AS metadata_B FROM links l JOIN meta ma ON l.item_A = ma.item JOIN meta mb ON l.item_B = mb.item"))
def q_links_with_metadata(spark, d):
    return G.links_with_metadata(_graph1(spark, d)[0], TD.feature_metadata_fx4(spark, d))


@query("sum_item_item_signals", Q._with(_G4_1 + [Q.EXTRA_FX5] + Q.g8(),
                                        _sel(["item", "overall_weight"], "ciw", ("overall_weight",))))
def q_sum_item_item_signals(spark, d):
    links, w = _graph1(spark, d)
    return G.add_item_item_signals(links, TD.item_item_signals_fx5(spark, d), w)[1]


@query("sum_item_item_links", Q._with(_G4_1 + [Q.EXTRA_FX5] + Q.g8(),
                                      _sel(["item_A", "item_B", "weight"], "clinks", ("weight",))))
def q_sum_item_item_links(spark, d):
    links, w = _graph1(spark, d)
    return G.add_item_item_signals(links, TD.item_item_signals_fx5(spark, d), w)[0]


@query("rec_add_item_item", Q._with(
    _G4_1 + [Q.EXTRA_FX5] + Q.g8() + Q.g5(FX1.prior, "clinks", "ciw")
    + Q.n2(FX1.initial_nhood_size, FX1.num_recs_per_item),
    _sel(REC_COLS, "recs", ("weight", "raw_weight")) + " WHERE raw_weight IS NOT NULL AND weight IS NOT NULL"))
def q_rec_add_item_item(spark, d):
    return R.item_item_recs_add_item_item(_fx1(spark, d), TD.item_item_signals_fx5(spark, d), FX1)


@query("rec_add_item_item_null", Q._with(
    _G4_1 + [Q.EXTRA_FX5] + Q.g8("null") + Q.g5(FX1.prior, "clinks", "ciw")
    + Q.n2(FX1.initial_nhood_size, FX1.num_recs_per_item),
    _sel(REC_COLS, "recs", ("weight", "raw_weight")) + " WHERE raw_weight IS NOT NULL AND weight IS NOT NULL"))
def q_rec_add_item_item_null(spark, d):
    """E4 as the reference's code behaves: an item missing on one side has no popularity."""
    return R.item_item_recs_add_item_item(_fx1(spark, d), TD.item_item_signals_fx5(spark, d), FX1, missing="null")


_RECS_1 = _G4_1 + Q.g5(FX1.prior) + Q.n2(FX1.initial_nhood_size, FX1.num_recs_per_item)


@query("user_recs", Q._with(_G4_1 + Q.g5(FX1.prior) + Q.n1(FX1.num_recs_per_item)
                            + Q.v3(FX1.num_recs_per_user, False), _sel(UREC_COLS, "urecs", UREC_D)))
def q_user_recs(spark, d):
    direct = N.direct_neighbours(_bayes1(spark, d), FX1.num_recs_per_item)
    return U.build_user_recs(_fx1(spark, d), direct, FX1.num_recs_per_user, False)


@query("user_recs_diverse", Q._with(_RECS_1 + Q.v3(FX1.num_recs_per_user, True), _sel(UREC_COLS, "urecs", UREC_D)))
def q_user_recs_diverse(spark, d):
    return U.build_user_recs(_fx1(spark, d), _recs1(spark, d), FX1.num_recs_per_user, True)


@query("rec_user_item", Q._with(_RECS_1 + Q.v3(FX1.num_recs_per_user, FX1.diversity_adjust),
                                _sel(UREC_COLS, "urecs", UREC_D)))
def q_rec_user_item(spark, d):
    return R.user_item_recs(_fx1(spark, d), _recs1(spark, d), FX1)


@query("item_weight_quantiles", Q._with(
    [Q.SIG_FX1, "iw AS (SELECT item, sum(weight) AS weight FROM sig GROUP BY item)"],
    f"SELECT quantile, {_s('value')} AS value FROM (SELECT unnest(CAST({S.TWENTY_ONE!r} AS DOUBLE[])) AS quantile, "
    f"unnest(quantile_cont(weight, CAST({S.TWENTY_ONE!r} AS DOUBLE[]))) AS value FROM iw)"))
def q_item_weight_quantiles(spark, d):
    return S.item_weight_quantiles(_fx1(spark, d), exact=True)


@query("item_weight_quantiles_approx",
       f"SELECT unnest(CAST({S.TWENTY_ONE!r} AS DOUBLE[])) AS quantile, true AS within_bound")
def q_item_weight_quantiles_approx(spark, d):
    """The default mode's promise: each value's rank is within n / accuracy of the wanted one."""
    found = S.item_weight_quantiles(_fx1(spark, d), exact=False, accuracy=APPROX_ACCURACY)
    weights = _fx1(spark, d).groupBy("item").agg(F.sum("weight").alias("weight"))
    eps = 1 / APPROX_ACCURACY + 1e-9
    return S.rank_bounds(weights, "weight", found).select("quantile", (
        (F.col("quantile") >= F.col("below") - eps) & (F.col("quantile") <= F.col("upto") + eps)).alias("within_bound"))


@query("item_rec_names", Q._with(
    _RECS_1 + Q.NAMES_FX7,
    f"SELECT r.item_A, na.name AS item_A_name, r.item_B, nb.name AS item_B_name, {_s('r.weight')} AS weight, "
    f"{_s('r.raw_weight')} AS raw_weight, r.rank FROM recs r JOIN inames nb ON r.item_B = nb.id "
    "JOIN inames na ON r.item_A = na.id ORDER BY r.item_A, r.rank"))
def q_item_rec_names(spark, d):
    return X.item_rec_names(_recs1(spark, d), TD.item_names_fx7(spark, d))


@query("user_rec_names", Q._with(
    _RECS_1 + Q.v3(FX1.num_recs_per_user, FX1.diversity_adjust) + Q.NAMES_FX7,
    f"SELECT r.\"user\", nu.name AS user_name, r.item, ni.name AS item_name, {_s('r.weight')} AS weight, "
    "r.reason_item, coalesce(nr.name, CAST(r.reason_item AS VARCHAR)) AS reason_item_name, "
    f"{_s('r.user_reason_item_weight')} AS user_reason_item_weight, "
    f"{_s('r.item_reason_item_weight')} AS item_reason_item_weight, r.rank FROM urecs r "
    "LEFT JOIN inames nr ON r.reason_item = nr.id JOIN inames ni ON r.item = ni.id "
    "JOIN unames nu ON r.\"user\" = nu.id ORDER BY r.\"user\", r.rank"))
def q_user_rec_names(spark, d):
    recs = R.user_item_recs(_fx1(spark, d), _recs1(spark, d), FX1)
    return X.user_rec_names(recs, TD.user_names_fx7(spark, d), TD.item_names_fx7(spark, d))


@query("logistic_round_trip", Q._with(
    [Q.SIG_FX1, "s AS (SELECT \"user\", item, sum(weight) AS weight FROM sig "
                "WHERE \"user\" IS NOT NULL AND item IS NOT NULL GROUP BY \"user\", item)",
     f"l AS (SELECT *, {Q._logistic('weight', FX1.logistic_param)} AS scaled FROM s)"],
    f"SELECT \"user\", item, {_s('weight')} AS weight, {_s('scaled')} AS scaled, "
    f"{_s(f'(-ln(2.0 / (scaled + 1.0) - 1.0) / {FX1.logistic_param!r})')} AS recovered FROM l"))
def q_logistic_round_trip(spark, d):
    s = (_fx1(spark, d).filter(F.col("user").isNotNull() & F.col("item").isNotNull())
         .groupBy("user", "item").agg(F.sum("weight").alias("weight")))
    s = s.withColumn("scaled", logistic_scale("weight", FX1.logistic_param))
    return s.withColumn("recovered", logistic_inverse("scaled", FX1.logistic_param))


@query("delimited_scan", Q._with([Q.SIG_FX1], _sel([U_, "item", "weight"], "sig", ("weight",))))
def q_delimited_scan(spark, d):
    path = scratch_folder(spark, "delimited-scan")
    IO.write_delimited(_fx1(spark, d), path)
    return IO.read_delimited(spark, path, IO.SIGNAL_SCHEMA)


# ============================================================================ FX2 family
def _fx2(spark, d):
    return TD.typed_signals_fx2(spark, d)


def _p2(spark, d):
    return fx2(TD.table(spark, d, "events").count())


def _detailed2(spark, d):
    p = _p2(spark, d)
    return D.build_item_item_graph_detailed(_fx2(spark, d), p.logistic_param, p.min_link_weight, p.max_links_per_user)


_G12 = [Q.SIG_FX2] + Q.g12(FX2)


@query("signal_type_counts", Q._with(
    [Q.SIG_FX2], "SELECT \"user\", item, signal_type, count(*) AS cnt FROM sig WHERE \"user\" IS NOT NULL "
                 "AND item IS NOT NULL AND signal_type IS NOT NULL AND signal_type <> '' GROUP BY ALL"))
def q_signal_type_counts(spark, d):
    return D.signal_type_counts(_fx2(spark, d))


@query("merge_signal_maps", Q._with(
    [Q.SIG_FX2], "SELECT \"user\", signal_type AS signal, count(*) AS cnt FROM sig WHERE \"user\" IS NOT NULL "
                 "AND item IS NOT NULL AND signal_type IS NOT NULL AND signal_type <> '' GROUP BY ALL"))
def q_merge_signal_maps(spark, d):
    maps = D.signal_type_map(_fx2(spark, d))
    merged = D.merge_signal_maps(maps, ["user"], "signal_types")
    return merged.select("user", F.explode("signal_types").alias("signal", "cnt"))


@query("detailed_graph", Q._with(_G12, _sel(["item_A", "item_B", "weight"], "links", ("weight",))))
def q_detailed_graph(spark, d):
    return _detailed2(spark, d)[0].select("item_A", "item_B", "weight")


@query("detailed_graph_signals", Q._with(_G12, "SELECT item_A, item_B, signal, cnt FROM lsig"))
def q_detailed_graph_signals(spark, d):
    return D.link_data_long(_detailed2(spark, d)[0])


@query("detailed_bayes", Q._with(
    _G12 + Q.g5(FX2.prior),
    f"SELECT a.item_A, a.item_B, {_s('a.weight')} AS weight, {_s('a.raw_weight')} AS raw_weight, s.cnt AS num_users "
    "FROM adj a JOIN lsig s ON s.item_A = a.item_A AND s.item_B = a.item_B AND s.signal = 'NUM_USERS'"))
def q_detailed_bayes(spark, d):
    links, w = _detailed2(spark, d)
    adj = G.bayes_adjust(links, w, FX2.prior, carry=["link_data"])
    return adj.select("item_A", "item_B", "weight", "raw_weight",
                      F.col("link_data")[D.NUM_USERS].alias("num_users"))


_DET_COLS = ["item_A", "item_B", "weight", "raw_weight", "rank", "linking_item", "signal", "cnt"]


def _detailed_long(recs: DataFrame) -> DataFrame:
    return recs.select("item_A", "item_B", "weight", "raw_weight", "rank", "linking_item",
                       F.explode_outer("link_data").alias("signal", "cnt"))


@query("detailed_two_hop", Q._with(_G12 + Q.g5(FX2.prior) + Q.n5_long(N2_NHOOD, N2_RECS),
                                   _sel(_DET_COLS, "recs_long", ("weight", "raw_weight"))))
def q_detailed_two_hop(spark, d):
    links, w = _detailed2(spark, d)
    adj = G.bayes_adjust(links, w, FX2.prior, carry=["link_data"])
    return _detailed_long(N.two_hop_neighbours(adj, N2_NHOOD, N2_RECS, carry=["link_data"],
                                               with_linking_item=True))


@query("rec_detailed", Q._with(_G12 + Q.g5(FX2.prior) + Q.n5_long(FX2.initial_nhood_size, FX2.num_recs_per_item),
                               _sel(_DET_COLS, "recs_long", ("weight", "raw_weight"))))
def q_rec_detailed(spark, d):
    return _detailed_long(R.item_item_recs_detailed(_fx2(spark, d), _p2(spark, d)))


@query("remove_bots", Q._with(
    [Q.SIG_FX2], f"SELECT \"user\", item, weight FROM sig WHERE \"user\" IN (SELECT \"user\" FROM sig "
                 f"GROUP BY \"user\" HAVING count(*) < {BOT_THRESHOLD})"))
def q_remove_bots(spark, d):
    return X.remove_bots(_fx2(spark, d), BOT_THRESHOLD)


@query("select_signals", Q._with(
    [Q.SIG_FX2],
    f"SELECT \"user\", item, signal_type AS signal FROM sig WHERE \"user\" IN (SELECT \"user\" FROM sig "
    f"WHERE item = {SELECT_ITEMS[0]}) AND \"user\" IN (SELECT \"user\" FROM sig WHERE item = {SELECT_ITEMS[1]}) "
    f"ORDER BY \"user\", item, signal"))
def q_select_signals(spark, d):
    sig = _fx2(spark, d).withColumnRenamed("signal_type", "signal")
    return X.select_signals(SELECT_ITEMS[0], SELECT_ITEMS[1], sig)


# ============================================================================ FX3 family
UNUSED = ["gravatar-ids", "contrib-signals", "interest-signals"]  # the tracks are filters of the canonical signals


def _events(spark, d, root=None):
    """Stage-1 tables of the FX3 event log, written once per query into the
    shared scratch folder and read back (lineage cut, no recomputation)."""
    return P.stage_parse(spark, TD.event_log_fx3(spark, d), root or scratch_folder(spark, "fx3"), FX3, skip=UNUSED)


def _lazy_events(spark, d):
    """The same six outputs as lazy plans, for queries that need only one."""
    return E.prepare_events(TD.event_log_fx3(spark, d), FX3.max_activity_considered)


def _stage2(spark, d):
    root = scratch_folder(spark, "fx3")
    tables = _events(spark, d, root)
    return tables | P.stage_item_graph(spark, root, FX3, skip=["item-item-recs"], tables=tables)


_EV = Q.events_all(FX3.max_activity_considered)
_PARSED_COLS = [U_, "item", "signal", "\"timestamp\"", "gravatar_id", "repo_name", "is_a_fork", "num_forks",
                "num_stars", "language", "description"]


_JSON_COLS = ["actor", "gravatar_id", "owner", "name", "fork", "language", "description", "stargazers", "forks",
              "type", "created_at"]


@query("json_scan", Q._with([Q.EVENTS_FX3], f"SELECT {', '.join(_JSON_COLS)} FROM logs"))
def q_json_scan(spark, d):
    """The event log written as JSON lines in two folders and scanned
    back with the nested schema; nested fields are read by path (P12)."""
    root = scratch_folder(spark, "json-scan")
    logs = TD.event_log_fx3(spark, d)
    forks = F.col("repository.fork") == "true"
    IO.write_event_logs(logs.filter(forks), f"{root}/a")
    IO.write_event_logs(logs.filter(~forks), f"{root}/b")
    scanned = IO.read_event_logs(spark, [f"{root}/a", f"{root}/b"])
    r = "repository"
    return scanned.select("actor", F.col("actor_attributes.gravatar_id").alias("gravatar_id"),
                          *[F.col(f"{r}.{c}").alias(c) for c in
                            ("owner", "name", "fork", "language", "description", "stargazers", "forks")],
                          "type", "created_at")


_YEARS = {"1993": "created_at < '1994'", "1995": "created_at >= '1994' AND created_at < '1996'", "1998": "created_at >= '1996'"}


@query("quarantine", Q._with(_EV, (
    "SELECT 'malformed' AS kind, '{\"actor\":\"' || actor AS line, count(*) AS n FROM logs WHERE type = 'IssuesEvent' GROUP BY actor "
    "UNION ALL SELECT 'event', \"user\", count(*) FROM parsed GROUP BY \"user\"")))
def q_quarantine(spark, d):
    """JSON lines of which all of one event type are cut off within the
    first value: they are found again in the quarantine table, the others are parsed."""
    root = scratch_folder(spark, "quarantine")
    logs = TD.event_log_fx3(spark, d)
    line = F.to_json(F.struct(*logs.columns))
    cut = F.concat(F.lit('{"actor":"'), F.col("actor"))
    logs.select(F.when(F.col("type") == "IssuesEvent", cut).otherwise(line).alias("value")).write.option("maxRecordsPerFile", IO.LOG_FILE_EVENTS).text(f"{root}/logs", compression="gzip")
    P.stage_parse(spark, IO.read_event_logs(spark, f"{root}/logs", keep_malformed=True), root, FX3, skip=UNUSED)
    bad = IO.read_table(spark, f"{root}/{P.QUARANTINE}").groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    good = IO.read_table(spark, f"{root}/parsed-logs").groupBy("user").agg(F.count(F.lit(1)).alias("n"))
    return bad.select(F.lit("malformed").alias("kind"), "line", "n").union(good.select(F.lit("event"), "user", "n"))


@query("daily_states", Q._with(_EV, (
    f"SELECT 'gravatar' AS kind, \"user\" AS key, gravatar_id AS other, CAST(NULL AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS value FROM grav "
    "UNION ALL SELECT 'fork', fork_item, source_item, NULL, NULL FROM fmap "
    f"UNION ALL SELECT 'quality', item, language, CAST(num_forks AS BIGINT), {_s('quality_score')} FROM quality "
    f"UNION ALL SELECT 'contrib', \"user\", item, count(*), {_s('sum(weight)')} FROM contrib GROUP BY \"user\", item "
    f"UNION ALL SELECT 'interest', \"user\", item, count(*), {_s('sum(weight)')} FROM interest GROUP BY \"user\", item")))
def q_daily_states(spark, d):
    """S5/S8 day by day: three runs, each reads its own part of the log and
    merges it into the states; the tables are those of a full run."""
    root = scratch_folder(spark, "days")
    logs = TD.event_log_fx3(spark, d)
    for day, part in _YEARS.items():
        IO.write_event_logs(logs.filter(part), f"{root}/logs/{day}")
        INC.advance(spark, IO.read_event_logs(spark, f"{root}/logs/{day}"), root, day)
    t = INC.stage_from_states(spark, root, f"{root}/tables", FX3)
    none = F.lit(None)
    sums = lambda kind, df: df.groupBy("user", "item").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("value")) \
        .select(F.lit(kind).alias("kind"), F.col("user").alias("key"), F.col("item").alias("other"), "n", "value")
    return (t["gravatar-ids"].select(F.lit("gravatar").alias("kind"), F.col("user").alias("key"), F.col("gravatar_id").alias("other"), none.cast("long").alias("n"), none.cast("double").alias("value"))
            .union(t["fork-map"].select(F.lit("fork"), "fork_item", "source_item", none.cast("long"), none.cast("double")))
            .union(t["item-metadata"].select(F.lit("quality"), "item", "language", F.col("num_forks").cast("long"), "quality_score"))
            .union(sums("contrib", t["contrib-signals"])).union(sums("interest", t["interest-signals"])))


@query("parse_events", Q._with(_EV, f"SELECT {', '.join(_PARSED_COLS)} FROM parsed"))
def q_parse_events(spark, d):
    return E.parse_events(TD.event_log_fx3(spark, d))


@query("latest_gravatar", Q._with(_EV, "SELECT \"user\", gravatar_id FROM grav"))
def q_latest_gravatar(spark, d):
    return _lazy_events(spark, d)["gravatar-ids"]


@query("latest_metadata", Q._with(_EV, "SELECT item, popularity, num_forks, num_stars, language, description "
                                       "FROM imeta"))
def q_latest_metadata(spark, d):
    return E.latest_metadata(E.parse_events(TD.event_log_fx3(spark, d)))


@query("fork_map", Q._with(_EV, "SELECT fork_item, source_item FROM fmap"))
def q_fork_map(spark, d):
    return _lazy_events(spark, d)["fork-map"]


@query("canonical_signals", Q._with(_EV, "SELECT \"user\", item, signal, mapped_from_fork FROM csig"))
def q_canonical_signals(spark, d):
    parsed = E.parse_events(TD.event_log_fx3(spark, d))
    return E.canonical_signals(parsed, E.fork_map(parsed))


@query("contrib_signals", Q._with(_EV, "SELECT \"user\", item, weight, mapped_from_fork FROM contrib"))
def q_contrib_signals(spark, d):
    return _lazy_events(spark, d)["contrib-signals"]


@query("interest_signals", Q._with(_EV, "SELECT \"user\", item, weight, mapped_from_fork FROM interest"))
def q_interest_signals(spark, d):
    return _lazy_events(spark, d)["interest-signals"]


@query("split_signals", Q._with(_EV, "SELECT \"user\", item, weight, mapped_from_fork, 'contrib' AS track FROM contrib "
                                    "UNION ALL SELECT \"user\", item, weight, mapped_from_fork, 'interest' AS track "
                                    "FROM interest"))
def q_split_signals(spark, d):
    """P6 + P7: one SPLIT of the canonical signals, written once, into the two tracks."""
    ev = _events(spark, d)
    return (ev["contrib-signals"].withColumn("track", F.lit("contrib"))
            .unionByName(ev["interest-signals"].withColumn("track", F.lit("interest"))))


_QCOLS = ["item", "quality_score", "activity", "popularity", "num_forks", "num_stars", "language", "description"]


@query("item_quality", Q._with(_EV, _sel(_QCOLS, "quality", ("quality_score", "activity", "popularity"))))
def q_item_quality(spark, d):
    return _lazy_events(spark, d)["item-metadata"]


@query("fit_logistic", Q._with(
    _EV, f"SELECT {_s('v')} AS quantile_value, {_s(f'(ln((1 + {QUALITY_Y!r}) / (1 - {QUALITY_Y!r})) / v)')} "
         f"AS logistic_param FROM (SELECT quantile_cont(quality_score, {QUALITY_Q!r}) AS v FROM quality)"))
def q_fit_logistic(spark, d):
    return fit_logistic_param(_lazy_events(spark, d)["item-metadata"], "quality_score", QUALITY_Q, QUALITY_Y, exact=True)


def _qgraph_inputs(spark, d):
    ev = _events(spark, d)
    return ev["interest-signals"], ev["item-metadata"]


_QG = _EV + Q.quality_graph(FX3)


@query("graph_quality_adjusted", Q._with(
    _EV + Q.g4(FX3, "interest") + [
        f"qw AS (SELECT w.item, w.overall_weight, {Q._logistic('q.quality_score', FX3.quality_logistic_param)} AS qm "
        f"FROM iw w JOIN quality q ON w.item = q.item)",
        f"adj AS (SELECT l.item_A, l.item_B, (l.weight * w.qm) / (w.overall_weight + {FX3.prior!r}) AS weight, "
        f"l.weight AS raw_weight FROM links l JOIN qw w ON l.item_B = w.item)"],
    _sel(["item_A", "item_B", "weight", "raw_weight"], "adj", ("weight", "raw_weight"))))
def q_graph_quality_adjusted(spark, d):
    sig, quality = _qgraph_inputs(spark, d)
    links, w = G.build_item_item_graph(sig, FX3.logistic_param, FX3.min_link_weight, FX3.max_links_per_user)
    return G.quality_adjust(links, w, quality, FX3.quality_logistic_param, FX3.prior)


@query("owner_diversity", Q._with(
    _EV + Q.g4(FX3, "interest") + Q.g5(FX3.prior) + Q.n1(FX3.num_recs_per_item) + Q.owner_div("recs", "odiv"),
    _sel(REC_COLS, "odiv", ("weight", "raw_weight"))))
def q_owner_diversity(spark, d):
    sig, _ = _qgraph_inputs(spark, d)
    links, w = G.build_item_item_graph(sig, FX3.logistic_param, FX3.min_link_weight, FX3.max_links_per_user)
    return G.owner_diversity(N.direct_neighbours(G.bayes_adjust(links, w, FX3.prior), FX3.num_recs_per_item))


def _qgraph(spark, d):
    sig, quality = _qgraph_inputs(spark, d)
    return R.quality_item_graph(sig, quality, FX3)


@query("rec_quality_item", Q._with(_QG, _sel(REC_COLS, "qgraph", ("weight", "raw_weight"))))
def q_rec_quality_item(spark, d):
    return _qgraph(spark, d)


_IRO = ("SELECT g.item_A AS item, g.rank, g.item_B AS rec, m.language, m.num_forks, m.num_stars, m.description "
        "FROM qgraph g JOIN quality m ON g.item_B = m.item")


@query("item_recs_output", Q._with(_QG, _IRO))
def q_item_recs_output(spark, d):
    ev = _events(spark, d)
    return R.item_recs_output(R.quality_item_graph(ev["interest-signals"], ev["item-metadata"], FX3), ev["item-metadata"])


@query("serving_item_recs", Q._with(
    _QG, "SELECT item AS repo_lowered, rank, rec, language AS lang, num_forks AS forks, num_stars AS stars, "
         f"description FROM ({_IRO})"))
def q_serving_item_recs(spark, d):
    return IO.serving_item_recs(q_item_recs_output(spark, d))


@query("keyed_sink", Q._with(
    _QG, "SELECT item AS repo_lowered, rank, rec, language AS lang, num_forks AS forks, num_stars AS stars, "
         f"description FROM ({_IRO})"))
def q_keyed_sink(spark, d):
    """S6 through the committing sink: stale rows of all keys are put first and
    replaced by the present ones, which are put twice."""
    rows = stored(IO.serving_item_recs(q_item_recs_output(spark, d)), "item-recs")
    path = scratch_folder(spark, "keyed")
    for put in (rows.withColumns({"rec": F.lit("stale"), "stars": F.lit(-1)}), rows, rows):
        KS.put_rows(put, path, "repo_lowered", "rank", buckets=8)
    return KS.read_rows(spark, path, rows.schema)


def _channels(spark, d):
    t = _stage2(spark, d)
    return t, R.both_channels(t["contrib-signals"], t["interest-signals"]), t["item-item-graph"]


_CH = _EV + Q.channels(FX3)


@query("channel_dedupe", Q._with(_CH, "SELECT \"user\", item, reason_item, rank, channel FROM dedup"))
def q_channel_dedupe(spark, d):
    _, signals, g = _channels(spark, d)
    return R.deduped_channels(signals, g, FX3)


@query("recs_fork_flag", Q._with(_CH, "SELECT \"user\", item, reason_item, old_rank, mapped_from_fork FROM iff"))
def q_recs_fork_flag(spark, d):
    ev, signals, g = _channels(spark, d)
    return U.recs_with_fork_flag(U.split_channel(R.deduped_channels(signals, g, FX3), 2), ev["interest-signals"])


_OUT_COLS = [U_, "rank", "item", "reason_item", "mapped_from_fork", "num_forks", "num_stars", "language",
             "description"]


@query("user_recs_output", Q._with(_CH, f"SELECT {', '.join(_OUT_COLS)} FROM cout"))
def q_user_recs_output(spark, d):
    ev, _, g = _channels(spark, d)
    return R.channel_recs(ev["contrib-signals"], ev["interest-signals"], g, ev["item-metadata"], FX3)[0]


@query("rec_channels", Q._with(_CH, f"SELECT {', '.join(_OUT_COLS)}, 1 AS channel FROM cout UNION ALL "
                                    f"SELECT {', '.join(_OUT_COLS)}, 2 AS channel FROM iout"))
def q_rec_channels(spark, d):
    return _rec_channels(spark, d, "worst")


def _rec_channels(spark, d, prefer):
    ev, signals, g = _channels(spark, d)
    return R.channel_outputs(R.deduped_channels(signals, g, FX3, prefer), signals, ev["item-metadata"])


_CH_BEST = _EV + Q.channels(FX3, "best")


@query("rec_channels_best", Q._with(_CH_BEST, f"SELECT {', '.join(_OUT_COLS)}, 1 AS channel FROM cout UNION ALL "
                                              f"SELECT {', '.join(_OUT_COLS)}, 2 AS channel FROM iout"))
def q_rec_channels_best(spark, d):
    """V4 as its comment in the application describes it: the better rank stays."""
    return _rec_channels(spark, d, "best")


@query("serving_user_recs", Q._with(
    _CH, "SELECT \"user\" AS user_lowered, rank, item AS rec, reason_item AS reason, mapped_from_fork AS reason_flag, "
         "num_forks AS forks, num_stars AS stars, language AS lang, description FROM iout"))
def q_serving_user_recs(spark, d):
    ev, _, g = _channels(spark, d)
    return IO.serving_user_recs(
        R.channel_recs(ev["contrib-signals"], ev["interest-signals"], g, ev["item-metadata"], FX3)[1])


@query("serving_gravatars", Q._with(_EV, "SELECT DISTINCT \"user\", gravatar_id AS gravatar FROM grav"))
def q_serving_gravatars(spark, d):
    return IO.serving_gravatars(_lazy_events(spark, d)["gravatar-ids"])


_META_COLS = ["item", "popularity", "num_forks", "num_stars", "language", "description"]


@query("delimited_metadata", Q._with(
    _EV, "SELECT item, popularity, num_forks, num_stars, chr(9) || language || chr(10) AS language, "
         "'\"' || description || chr(13) || chr(10) || ' ' AS description, num_forks > num_stars AS flag, "
         "CASE WHEN num_forks % 2 = 0 THEN '' END AS empty FROM imeta"))
def q_delimited_metadata(spark, d):
    """S3/S4 on a table of strings, numbers and booleans: tabs, quotes, line
    breaks, blanks, empty strings and nulls survive the round trip."""
    meta = E.latest_metadata(E.parse_events(TD.event_log_fx3(spark, d))).select(
        "item", "popularity", "num_forks", "num_stars", F.concat(F.lit("\t"), "language", F.lit("\n")).alias("language"),
        F.concat(F.lit('"'), "description", F.lit("\r\n ")).alias("description"),
        (F.col("num_forks") > F.col("num_stars")).alias("flag"), F.when(F.col("num_forks") % 2 == 0, "").alias("empty"))
    path = scratch_folder(spark, "delimited-metadata")
    IO.write_delimited(meta, path)
    return IO.read_delimited(spark, path, meta.schema)


_SERVED = ["serving", "hash_key", "range_key", "value", "reason", "flag"]
_SERVED_SQL = (
    "SELECT 'gravatars' AS serving, \"user\" AS hash_key, NULL::INTEGER AS range_key, gravatar_id AS value, NULL::VARCHAR AS reason, NULL::INTEGER AS flag FROM grav "
    f"UNION ALL SELECT 'item-recs', item, rank, rec, NULL, NULL FROM ({_IRO}) "
    "UNION ALL SELECT 'user-contrib-recs', \"user\", rank, item, reason_item, mapped_from_fork FROM cout "
    "UNION ALL SELECT 'user-interest-recs', \"user\", rank, item, reason_item, mapped_from_fork FROM iout")


@query("staged_serving", Q._with(_CH, _SERVED_SQL))
def q_staged_serving(spark, d):
    """The event log as JSON files, the four stages, keys checked, the
    dated serving tables written and read back."""
    root = scratch_folder(spark, "staged")
    IO.write_event_logs(TD.event_log_fx3(spark, d), f"{root}/logs")
    P.run_pipeline(spark, f"{root}/logs", f"{root}/tables", FX3, snapshot="2014-01-01")
    columns = {"gravatars": ("user", None, "gravatar", None, None), "item-recs": ("repo_lowered", "rank", "rec", None, None)}
    out = None
    for name in P.SERVING:
        h, r, v, reason, flag = columns.get(name, ("user_lowered", "rank", "rec", "reason", "reason_flag"))
        pick = lambda c, kind: (F.col(c) if c else F.lit(None)).cast(kind)
        rows = IO.read_table(spark, f"{root}/tables/serving/{name}_2014-01-01").select(
            F.lit(name).alias("serving"), pick(h, "string").alias("hash_key"), pick(r, "int").alias("range_key"), pick(v, "string").alias("value"),
            pick(reason, "string").alias("reason"), pick(flag, "int").alias("flag"))
        out = rows if out is None else out.unionByName(rows)
    return out
