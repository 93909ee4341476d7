"""DuckDB twins of the registered queries (the correctness gate).

Each query is built from small CTE fragments mirroring the Spark operators.
Orderings use the same explicit tie-breaks and rounded sort keys as the
engine; values are compared by their first nine decimal digits, which is not the
engine's own rule (significant bits), so the twins do not share its rounding.
"""

from __future__ import annotations

from cograph.operators import events as E
from cograph.operators.graph import OWNER_PATTERN
from cograph.params import RecParams


def _sk(x: str) -> str:
    """Sort value: nine significant decimal digits."""
    return f"CAST(format('{{:.8e}}', {x}) AS DOUBLE)"


def shown(x: str, bits: int) -> str:
    """A double with ``bits`` significant bits, as registered queries show it."""
    k = f"CAST({2 ** (53 - bits) + 1} AS DOUBLE)"
    return f"CASE WHEN abs({x}) < 1e290 THEN {x} * {k} - ({x} * {k} - {x}) ELSE {x} END"


def _logistic(x: str, p: float) -> str:
    return f"(-1.0 + 2.0 / (1.0 + exp(-{float(p)!r} * ({x}))))"


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _dbl(v: float | str) -> str:
    if isinstance(v, str):  # an expression
        return v
    return f"CAST({float(v)!r} AS DOUBLE)"


# ----------------------------------------------------------------------------- inputs
SIG_FX1 = ("sig AS (SELECT o_custkey AS \"user\", l_partkey AS item, "
           "CASE WHEN l_returnflag = 'R' THEN 3.0 ELSE 1.0 END::DOUBLE AS weight "
           "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)")

SIG_FX2 = ("sig AS (SELECT user_id AS \"user\", CAST(json_extract_string(props, '$.k') AS INTEGER) AS item, "
           "event_type AS signal_type, "
           "CASE WHEN event_type = 'purchase' THEN 3.0 ELSE 1.0 END::DOUBLE AS weight FROM events)")

EVENTS_FX3 = """logs AS (SELECT c_name AS actor,
       CASE WHEN c_custkey % 2 = 0 THEN md5(c_name) WHEN c_custkey % 3 = 0 THEN 'short' END AS gravatar_id,
       p_brand AS owner,
       CASE WHEN p_name = 'cold rod' THEN 'Spoon-Knife' ELSE p_name END AS name,
       CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) <= 8 THEN 'true' ELSE 'false' END AS fork,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS language,
       'about ' || p_name || ' ' || repeat('x', 120) AS description,
       CAST(p_size * 4 AS INTEGER) AS stargazers, CAST(p_size AS INTEGER) AS forks,
       CASE WHEN l_returnflag = 'R' THEN 'ForkEvent'
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'PullRequestEvent'
            WHEN l_returnflag = 'A' THEN 'PushEvent'
            WHEN l_linestatus = 'O' THEN 'WatchEvent' ELSE 'IssuesEvent' END AS type,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey)"""

META_FX4 = "meta AS (SELECT p_partkey AS item, p_brand AS metadata_field FROM part)"

EXTRA_FX5 = ("extra AS (SELECT x.l_partkey AS item_A, y.l_partkey AS item_B, "
             "CASE WHEN x.l_discount >= 0.08 THEN -1.0 ELSE 2.0 END::DOUBLE AS weight "
             "FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey "
             "AND x.l_linenumber + 1 = y.l_linenumber WHERE x.l_partkey <> y.l_partkey)")

SRC_FX6 = "src AS (SELECT p_partkey AS item FROM part WHERE p_size <= 40)"
DST_FX6 = "dst AS (SELECT p_partkey AS item FROM part WHERE p_type <> 'ECONOMY')"
NAMES_FX7 = ["inames AS (SELECT p_partkey AS id, p_name AS name FROM part)",
             "unames AS (SELECT c_custkey AS id, c_name AS name FROM customer)"]


# ----------------------------------------------------------------------------- G1-G5
def g1(p: float, src: str = "sig") -> list[str]:
    return [f"ui AS (SELECT \"user\", item, {_logistic('w', p)} AS weight FROM "
            f"(SELECT \"user\", item, sum(weight) AS w FROM {src} "
            f"WHERE \"user\" IS NOT NULL AND item IS NOT NULL GROUP BY \"user\", item) WHERE w IS NOT NULL)"]


def g2() -> list[str]:
    return ["iw AS (SELECT item, sum(weight) AS overall_weight FROM ui GROUP BY item)"]


def ui_filtered(min_w: float) -> list[str]:
    return [f"uif AS (SELECT * FROM ui WHERE item IN "
            f"(SELECT item FROM iw WHERE overall_weight >= {_dbl(min_w)}))"]


def top_users(k: int | None) -> list[str]:
    if k is None:
        return ["top AS (SELECT * FROM uif)"]
    return [f"top AS (SELECT *, row_number() OVER (PARTITION BY \"user\" ORDER BY {_sk('weight')} DESC NULLS LAST, "
            f"item ASC NULLS LAST) AS urank FROM uif QUALIFY urank <= {k})"]


def g4(p: RecParams, src: str = "sig") -> list[str]:
    m = _dbl(p.min_link_weight)
    return g1(p.logistic_param, src) + g2() + ui_filtered(p.min_link_weight) + top_users(p.max_links_per_user) + [
        f"half AS (SELECT a.item AS item_A, b.item AS item_B, sum(least(a.weight, b.weight)) AS weight "
        f"FROM top a JOIN top b ON a.\"user\" = b.\"user\" AND a.item < b.item GROUP BY a.item, b.item "
        f"HAVING sum(least(a.weight, b.weight)) >= {m})",
        "links AS (SELECT item_A, item_B, weight FROM half UNION ALL SELECT item_B, item_A, weight FROM half)"]


def g5(prior: float, links: str = "links", weights: str = "iw", name: str = "adj",
       carry: str = "") -> list[str]:
    return [f"{name} AS (SELECT l.item_A, l.item_B, l.weight / (w.overall_weight + {_dbl(prior)}) AS weight, "
            f"l.weight AS raw_weight{carry} FROM {links} l JOIN {weights} w ON l.item_B = w.item)"]


def g6(prior: float, boost: str) -> list[str]:
    f = {"SQRT": "sqrt(w.overall_weight)", "LOG": "ln(w.overall_weight)", "": "w.overall_weight"}[boost]
    return [f"adj AS (SELECT l.item_A, l.item_B, (l.weight * {f}) / (w.overall_weight + {_dbl(prior)}) AS weight, "
            f"l.weight AS raw_weight FROM links l JOIN iw w ON l.item_B = w.item)"]


def g8(missing: str = "zero") -> list[str]:
    total = ("coalesce(w.overall_weight, 0.0) + coalesce(e.extra_weight, 0.0)" if missing == "zero"
             else "w.overall_weight + e.extra_weight")
    return [
        "xsum AS (SELECT item_A AS item, sum(weight) AS extra_weight FROM extra GROUP BY item_A)",
        f"ciw AS (SELECT coalesce(w.item, e.item) AS item, "
        f"CASE WHEN {total} < 0 THEN 0.0 ELSE {total} END::DOUBLE AS overall_weight "
        f"FROM iw w FULL OUTER JOIN xsum e ON w.item = e.item)",
        "clinks AS (SELECT * FROM (SELECT item_A, item_B, weight FROM links UNION ALL "
        "SELECT item_A, item_B, weight FROM extra) WHERE weight > 0)"]


def g9(src: str = "adj", name: str = "dadj") -> list[str]:
    return [f"{name} AS (SELECT item_A, item_B, weight / CAST(row_number() OVER (PARTITION BY item_A, metadata_field "
            f"ORDER BY {_sk('weight')} DESC NULLS LAST, item_B ASC NULLS LAST) AS DOUBLE) AS weight, raw_weight "
            f"FROM (SELECT l.item_A, l.item_B, l.weight, l.raw_weight, m.metadata_field "
            f"FROM {src} l JOIN meta m ON l.item_B = m.item))"]


# ----------------------------------------------------------------------------- N1-N5
def n1(n: int, src: str = "adj", name: str = "recs") -> list[str]:
    return [f"{name} AS (SELECT item_A, item_B, weight, raw_weight, CAST(row_number() OVER (PARTITION BY item_A "
            f"ORDER BY {_sk('weight')} DESC NULLS LAST, item_B ASC NULLS LAST) AS INTEGER) AS rank "
            f"FROM {src} QUALIFY rank <= {n})"]


def _pruned(nhood: int, src: str, name: str, carry: str = "") -> list[str]:
    return [f"{name} AS (SELECT item_A, item_B, 1.0 / weight AS dist, raw_weight{carry} FROM {src} WHERE weight > 0 "
            f"QUALIFY row_number() OVER (PARTITION BY item_A ORDER BY {_sk('1.0 / weight')} ASC NULLS LAST, "
            f"item_B ASC NULLS LAST) <= {nhood})"]


def _best(n: int, cand_direct: str, cand_two: str, name: str, carry_cols: str = "") -> list[str]:
    return [
        f"cand AS ({cand_direct} UNION ALL {cand_two})",
        f"best AS (SELECT * FROM cand WHERE item_A <> item_B QUALIFY row_number() OVER (PARTITION BY item_A, item_B "
        f"ORDER BY {_sk('dist')} ASC NULLS LAST, indirect ASC, mid ASC NULLS FIRST, "
        f"{_sk('raw_weight')} ASC NULLS FIRST) = 1)",
        f"{name} AS (SELECT item_A, item_B, 1.0 / dist AS weight, raw_weight, CAST(row_number() OVER "
        f"(PARTITION BY item_A ORDER BY {_sk('dist')} ASC NULLS LAST, item_B ASC NULLS LAST) AS INTEGER) AS rank, "
        f"mid{carry_cols} FROM best QUALIFY rank <= {n})"]


def n2(nhood: int, n: int, src: str = "adj", name: str = "recs") -> list[str]:
    return _pruned(nhood, src, "g") + _best(
        n, "SELECT item_A, item_B, dist, raw_weight, NULL AS mid, 0 AS indirect FROM g",
        "SELECT g1.item_A, g2.item_B, g1.dist + g2.dist, NULL, g1.item_B, 1 FROM g g1 JOIN g g2 ON g1.item_B = g2.item_A",
        name)


def n4(nhood: int, n: int, src: str = "adj", name: str = "recs") -> list[str]:
    return _pruned(nhood, src, "gall") + [
        "g AS (SELECT * FROM gall WHERE item_A IN (SELECT item FROM src))"] + _best(
        n, "SELECT item_A, item_B, dist, raw_weight, NULL AS mid, 0 AS indirect FROM g "
           "WHERE item_B IN (SELECT item FROM dst)",
        "SELECT g1.item_A, g2.item_B, g1.dist + g2.dist, NULL, g1.item_B, 1 FROM g g1 JOIN gall g2 "
        "ON g1.item_B = g2.item_A WHERE g2.item_B IN (SELECT item FROM dst)", name)


# ----------------------------------------------------------------------------- V1-V3
def v3(n: int, diversity: bool, sig: str = "sig", recs: str = "recs", name: str = "urecs") -> list[str]:
    adj = (f"weight / CAST(row_number() OVER (PARTITION BY \"user\", reason ORDER BY {_sk('weight')} DESC NULLS LAST, "
           f"item ASC NULLS LAST) + 1 AS DOUBLE)") if diversity else "weight"
    return [
        f"{name}_s AS (SELECT \"user\", item, weight FROM {sig} WHERE \"user\" IS NOT NULL AND item IS NOT NULL)",
        f"{name}_c AS (SELECT s.\"user\", r.item_B AS item, sqrt(s.weight * r.weight) AS weight, r.item_A AS reason, "
        f"s.weight AS user_link, r.raw_weight AS item_link FROM {name}_s s JOIN {recs} r ON s.item = r.item_A)",
        f"{name}_u AS (SELECT * FROM {name}_c c WHERE NOT EXISTS (SELECT 1 FROM {name}_s s "
        f"WHERE s.\"user\" = c.\"user\" AND s.item = c.item))",
        f"{name}_b AS (SELECT * FROM {name}_u QUALIFY row_number() OVER (PARTITION BY \"user\", item "
        f"ORDER BY {_sk('weight')} DESC, reason ASC) = 1)",
        f"{name}_d AS (SELECT *, {adj} AS adj FROM {name}_b)",
        f"{name} AS (SELECT \"user\", item, weight, reason AS reason_item, user_link AS user_reason_item_weight, "
        f"item_link AS item_reason_item_weight, CAST(row_number() OVER (PARTITION BY \"user\" "
        f"ORDER BY {_sk('adj')} DESC NULLS LAST, item ASC NULLS LAST) AS INTEGER) AS rank FROM {name}_d "
        f"QUALIFY rank <= {n})"]


# ----------------------------------------------------------------------------- events
def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def parsed() -> list[str]:
    return [EVENTS_FX3, f"""parsed AS (SELECT * FROM (SELECT lower(actor) AS "user",
        lower(owner || '/' || name) AS item, type AS signal, created_at AS "timestamp", gravatar_id,
        name AS repo_name, coalesce(fork = 'true', false) AS is_a_fork, forks AS num_forks, stargazers AS num_stars,
        coalesce(language, '{E.UNKNOWN_LANGUAGE}') AS language, substr(description, 1, {E.DESCRIPTION_CHARS}) AS description
      FROM logs WHERE actor IS NOT NULL AND owner IS NOT NULL AND name IS NOT NULL AND fork IS NOT NULL
        AND type IS NOT NULL AND created_at IS NOT NULL
        AND type IN {_in(E.SIGNAL_EVENT_TYPES)}
        AND name NOT IN {_in(E.DEMO_REPO_NAMES)}) WHERE NOT starts_with(item, '/'))"""]


def _d(cols: list[str]) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def gravatars() -> list[str]:
    return [f"""grav AS (SELECT "user", gravatar_id FROM parsed WHERE length(gravatar_id) = {E.GRAVATAR_ID_CHARS}
        QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY {_d(['"timestamp"', 'gravatar_id'])}) = 1)"""]


def metadata() -> list[str]:
    return [f"""imeta AS (SELECT item, 2 * num_forks + num_stars AS popularity, num_forks, num_stars, language, description
        FROM parsed WHERE NOT is_a_fork QUALIFY row_number() OVER (PARTITION BY item ORDER BY
        {_d(['"timestamp"', 'is_a_fork', 'num_forks', 'num_stars', 'language', 'description'])}) = 1)"""]


def forkmap() -> list[str]:
    return [f"""forks AS (SELECT item, repo_name, language FROM parsed WHERE is_a_fork QUALIFY row_number() OVER
        (PARTITION BY item ORDER BY {_d(['"timestamp"', 'repo_name', 'is_a_fork', 'num_forks', 'language'])}) = 1)""",
            f"""sources AS (SELECT item, repo_name, language FROM parsed WHERE NOT is_a_fork QUALIFY row_number() OVER
        (PARTITION BY repo_name, language ORDER BY {_d(['num_forks', 'item', '"timestamp"'])}) = 1)""",
            """fmap AS (SELECT f.item AS fork_item, s.item AS source_item FROM forks f JOIN sources s
        ON f.repo_name = s.repo_name AND f.language = s.language)"""]


def canonical() -> list[str]:
    return ["""csig AS (SELECT p."user", coalesce(m.source_item, p.item) AS item, p.signal,
        m.source_item IS NOT NULL AS mapped_from_fork FROM parsed p LEFT JOIN fmap m ON p.item = m.fork_item)""",
            f"""contrib AS (SELECT "user", item, 1.0::DOUBLE AS weight, mapped_from_fork FROM csig
        WHERE signal IN {_in(E.CONTRIB_EVENT_TYPES)})""",
            f"""interest AS (SELECT "user", item, CASE WHEN signal = '{E.FORK_EVENT_TYPE}' THEN 3.0 ELSE 1.0 END::DOUBLE AS weight,
        mapped_from_fork FROM csig WHERE signal NOT IN {_in(E.CONTRIB_EVENT_TYPES)} OR signal IS NULL)"""]


def quality(cap: float) -> list[str]:
    return [f"""quality AS (SELECT m.item, m.popularity * sqrt(least(a.activity, {_dbl(cap)})) AS quality_score,
        a.activity, CAST(m.popularity AS DOUBLE) AS popularity, m.num_forks, m.num_stars, m.language, m.description
        FROM (SELECT item, sum(weight) AS activity FROM contrib GROUP BY item) a JOIN imeta m ON a.item = m.item)"""]


def events_all(cap: float = 64.0) -> list[str]:
    return parsed() + gravatars() + metadata() + forkmap() + canonical() + quality(cap)


def quality_graph(p: RecParams) -> list[str]:
    """E8 graph part over the interest signals -> qgraph."""
    m = _dbl(p.min_link_weight)
    return g4(p, "interest") + [
        f"qw AS (SELECT w.item, w.overall_weight, {_logistic('q.quality_score', p.quality_logistic_param)} AS qm "
        f"FROM iw w JOIN quality q ON w.item = q.item)",
        f"adj AS (SELECT l.item_A, l.item_B, (l.weight * w.qm) / (w.overall_weight + {_dbl(p.prior)}) AS weight, "
        f"l.weight AS raw_weight FROM links l JOIN qw w ON l.item_B = w.item)"] + n1(p.num_recs_per_item) + owner_div("recs", "qgraph")


def owner_div(src: str, name: str) -> list[str]:
    return [f"""{name}_o AS (SELECT item_A, item_B, weight / CAST(row_number() OVER (PARTITION BY item_A,
        CASE WHEN contains(CAST(item_B AS VARCHAR), '/') THEN regexp_extract(CAST(item_B AS VARCHAR), '{OWNER_PATTERN}', 1) END
        ORDER BY {_sk('weight')} DESC NULLS LAST, item_B ASC NULLS LAST) AS DOUBLE) AS weight, raw_weight FROM {src})""",
            f"""{name} AS (SELECT item_A, item_B, weight, raw_weight, CAST(row_number() OVER (PARTITION BY item_A
        ORDER BY {_sk('weight')} DESC NULLS LAST, item_B ASC NULLS LAST) AS INTEGER) AS rank FROM {name}_o)"""]


def channels(p: RecParams, prefer: str = "worst") -> list[str]:
    n = p.num_recs_per_user
    return (quality_graph(p) + v3(n, p.diversity_adjust, "contrib", "qgraph", "crecs")
            + v3(n, p.diversity_adjust, "interest", "qgraph", "irecs") + [
        """dedup AS (SELECT * FROM (SELECT "user", item, reason_item, rank, 1 AS channel FROM crecs UNION ALL
        SELECT "user", item, reason_item, rank, 2 AS channel FROM irecs) QUALIFY row_number() OVER
        (PARTITION BY "user", item ORDER BY rank """ + ("DESC" if prefer == "worst" else "ASC") + """ NULLS LAST, channel ASC) = 1)""",
        """cflag AS (SELECT "user", item, -max(CASE WHEN mapped_from_fork = true THEN -1 ELSE 0 END) AS mapped_from_fork
        FROM contrib GROUP BY "user", item)""",
        """iflag AS (SELECT "user", item, -max(CASE WHEN mapped_from_fork = true THEN -1 ELSE 0 END) AS mapped_from_fork
        FROM interest GROUP BY "user", item)""",
        """cff AS (SELECT r."user", r.item, r.reason_item, r.rank AS old_rank, f.mapped_from_fork FROM dedup r
        JOIN cflag f ON r."user" = f."user" AND r.reason_item = f.item WHERE r.channel = 1)""",
        """iff AS (SELECT r."user", r.item, r.reason_item, r.rank AS old_rank, f.mapped_from_fork FROM dedup r
        JOIN iflag f ON r."user" = f."user" AND r.reason_item = f.item WHERE r.channel = 2)"""] + post("cff", "cout") + post("iff", "iout"))


def post(src: str, name: str) -> list[str]:
    return [f"""{name} AS (SELECT r."user", CAST(row_number() OVER (PARTITION BY r."user" ORDER BY r.old_rank ASC NULLS LAST,
        m.item ASC NULLS LAST) AS INTEGER) AS rank, m.item, r.reason_item, r.mapped_from_fork, m.num_forks, m.num_stars,
        m.language, m.description FROM {src} r JOIN quality m ON r.item = m.item)"""]


# ----------------------------------------------------------------------------- detailed
def g12(p: RecParams) -> list[str]:
    m = _dbl(p.min_link_weight)
    return [
        "pt AS (SELECT \"user\", item, signal_type, sum(weight) AS w, count(*) AS cnt FROM sig "
        "WHERE \"user\" IS NOT NULL AND item IS NOT NULL GROUP BY \"user\", item, signal_type)",
        f"ui AS (SELECT \"user\", item, {_logistic('w', p.logistic_param)} AS weight FROM "
        f"(SELECT \"user\", item, sum(w) AS w FROM pt GROUP BY \"user\", item) WHERE w IS NOT NULL)",
        "types AS (SELECT \"user\", item, signal_type, cnt FROM pt WHERE signal_type IS NOT NULL "
        "AND signal_type <> '' AND signal_type <> 'NUM_USERS')"] + g2() + ui_filtered(p.min_link_weight) + top_users(
        p.max_links_per_user) + [
        "pairs AS (SELECT a.\"user\", a.item AS item_A, b.item AS item_B, least(a.weight, b.weight) AS w "
        "FROM top a JOIN top b ON a.\"user\" = b.\"user\" AND a.item < b.item)",
        f"half AS (SELECT item_A, item_B, sum(w) AS weight, count(*) AS num_users FROM pairs GROUP BY item_A, item_B "
        f"HAVING sum(w) >= {m})",
        "hsig AS (SELECT p.item_A, p.item_B, t.signal_type AS signal, CAST(sum(t.cnt) AS BIGINT) AS cnt FROM pairs p "
        "JOIN half h ON h.item_A = p.item_A AND h.item_B = p.item_B JOIN types t "
        "ON t.\"user\" = p.\"user\" AND (t.item = p.item_A OR t.item = p.item_B) "
        "GROUP BY p.item_A, p.item_B, t.signal_type "
        "UNION ALL SELECT item_A, item_B, 'NUM_USERS', num_users FROM half)",
        "links AS (SELECT item_A, item_B, weight FROM half UNION ALL SELECT item_B, item_A, weight FROM half)",
        "lsig AS (SELECT item_A, item_B, signal, cnt FROM hsig UNION ALL SELECT item_B, item_A, signal, cnt FROM hsig)"]


def n5_long(nhood: int, n: int) -> list[str]:
    return n2(nhood, n, "adj", "recs") + [
        "recs_long AS (SELECT r.item_A, r.item_B, r.weight, r.raw_weight, r.rank, "
        "CASE WHEN r.raw_weight IS NULL THEN r.mid END AS linking_item, s.signal, s.cnt FROM recs r "
        "LEFT JOIN lsig s ON r.raw_weight IS NOT NULL AND s.item_A = r.item_A AND s.item_B = r.item_B)"]
