"""Numbered sequences, carried values, blocks and as-of lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from hilvan.catalog.base import LINE_ORDER, select, shape, table
from hilvan.operators import ordered as O
from hilvan.operators import sequence as S
from hilvan.plans import history

ROWS = [*LINE_ORDER, "l_linestatus", "l_returnflag", "l_linenumber * 3 AS number"]


def _numbers(spark, d, find, number="l_linenumber"):
    rows = shape(spark, d, "lineitem", ROWS)
    order = [c for c in LINE_ORDER if c not in ("l_orderkey", number)]
    return find(rows, ["l_orderkey"], number, order, ["l_partkey", "l_suppkey"])


def repeats(spark, d):
    return S.repeated_numbers(_numbers(spark, d, S.first_two)).select(
        "l_orderkey", "l_linenumber", F.col("first.l_partkey").alias("first_part"),
        F.col("first.l_suppkey").alias("first_supp"), F.col("second.l_partkey").alias("second_part"),
        F.col("second.l_suppkey").alias("second_supp"),
    )


def gaps(spark, d):
    out = S.sequence_gaps(_numbers(spark, d, S.distinct_numbers, "number"), ["l_orderkey"], "number")
    return out.select("l_orderkey", "number", "following", "missing", F.col("first.l_partkey").alias("part"))


def gaps_in_chunks(spark, d):
    """The same gaps with three numbers per window."""
    out = S.sequence_gaps(_numbers(spark, d, S.distinct_numbers), ["l_orderkey"], "l_linenumber", per_chunk=3)
    return out.select("l_orderkey", "l_linenumber", "following", "missing")


def states(spark, d):
    rows = shape(spark, d, "lineitem", ROWS)
    order = [c for c in LINE_ORDER if c not in ("l_orderkey", "l_linenumber")]
    return S.state_sequence(
        rows, ["l_orderkey"], "l_linenumber", order, F.col("l_linestatus") == "O", ["l_returnflag"]
    )


EVENTS = ["user_id", "event_id", "event_type", "value", "ts", "CAST(ts AS DATE) AS day"]


def carried(spark, d):
    """Last error value and last view per user, by day; first to the next event."""
    rows = shape(spark, d, "events", EVENTS)
    return O.carry_forward(
        rows, ["user_id"], ["day"], ["ts", "event_id"],
        values={"last_error": F.when(F.col("event_type") == "error", F.col("value"))},
        before={"view_before": F.when(F.col("event_type") == "view", F.col("event_id"))},
    ).select("user_id", "event_id", "last_error", "view_before")


def collapsed(spark, d):
    rows = shape(spark, d, "events", EVENTS)
    return O.collapse_repeats(rows, ["user_id"], ["day"], ["ts", "event_id"], ["event_type"]).select(
        "user_id", "event_id", "event_type"
    )


def counted(spark, d):
    rows = shape(spark, d, "events", EVENTS)
    return O.running_total(
        rows, ["user_id"], ["day"], ["ts", "event_id"],
        F.when(F.col("event_type") == "purchase", 1).otherwise(0), "purchases",
    ).select("user_id", "event_id", "purchases")


def open_block(spark, d):
    """First run of one event type that starts at a user's first cheap event."""
    rows = shape(spark, d, "events", EVENTS)
    return O.first_open_block(
        rows, ["user_id"], ["day"], ["ts", "event_id"], "event_type", F.col("value") < 5
    ).select("user_id", "event_id", "event_type")


def as_of(spark, d):
    """Value of the last event before every purchase of the same user."""
    objects = table(spark, d, "events").filter("event_type = 'purchase'").selectExpr(
        "user_id", "ts AS at", "event_id"
    )
    versions = table(spark, d, "events").filter("event_type <> 'purchase'").selectExpr(
        "user_id", "ts AS at", "event_id AS version_id", "event_type AS version_type", "value AS version_value"
    )
    return O.as_of(
        objects, versions, ["user_id"], "at", ["version_id", "version_type", "version_value"]
    ).drop("at")


OBJECTS = ["l_orderkey * 10 + l_linenumber AS id", "CASE WHEN l_quantity = 7 THEN NULL ELSE l_partkey * 3 END AS version"]
ALTERNATIVES = [
    "CASE WHEN o_orderkey % 5 = 0 THEN 'design' ELSE 'gis' END AS dataset_name", "o_orderkey % 4000 + 90 AS version",
    "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS scheme_id", "o_orderpriority AS alternative_name",
    "o_orderkey AS seq",
]
SCHEMES = [
    "CASE WHEN c_custkey % 7 = 0 THEN -c_custkey ELSE c_custkey END AS scheme_id", "c_name AS name", "c_mktsegment AS owner",
    "'U' || CAST(c_custkey % 9 AS STRING) AS modified_by", "CAST(c_custkey % 28 AS STRING) AS modified_at",
    "CASE WHEN c_acctbal > 0 THEN 'open' ELSE 'closed' END AS status", "c_nationkey AS project_id",
]
PROJECTS = [
    "CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_nationkey END AS project_id", "n_name AS name",
    "'job ' || n_name AS job_title", "CAST(n_regionkey AS STRING) AS owning_group", "'P' AS modified_by",
    "CAST(n_nationkey AS STRING) AS modified_at",
]


def responsible(spark, d):
    """Alternative, scheme and project behind the version of every line item."""
    tables = (("lineitem", OBJECTS), ("orders", ALTERNATIVES), ("customer", SCHEMES), ("nation", PROJECTS))
    return history.responsible(*[shape(spark, d, name, columns) for name, columns in tables])


QUERIES = {
    "sequence_dups": repeats,
    "sequence_gaps": gaps,
    "sequence_gaps_chunked": gaps_in_chunks,
    "state_sequence": states,
    "carry_forward": carried,
    "collapse_repeats": collapsed,
    "running_total": counted,
    "first_open_block": open_block,
    "version_asof": as_of,
    "version_responsible": responsible,
}

_REST = "l_partkey, l_suppkey, l_extendedprice, l_shipdate"


def _gaps(number: str, columns: str) -> str:
    return f"""WITH r AS ({select('lineitem', ROWS)}),
u AS (SELECT l_orderkey, {number} AS n, count(*) AS c, arg_min(l_partkey, (l_linenumber, {_REST})) AS part FROM r GROUP BY ALL),
g AS (SELECT *, lead(n) OVER (PARTITION BY l_orderkey ORDER BY n) AS m, max(c) OVER (PARTITION BY l_orderkey) AS rep FROM u)
SELECT l_orderkey, n AS {number}, m AS following,
  CASE WHEN m - n <= 4 THEN array_to_string(list_transform(range(n + 1, m), lambda x: '_' || x), ', ')
       ELSE '_' || (n + 1) || ' al _' || (m - 1) END AS missing{columns}
FROM g WHERE rep = 1 AND m - n >= 2"""


_EV = f"r AS ({select('events', EVENTS)})"
_W = "PARTITION BY user_id ORDER BY ts, event_id"

SQL = {
    "sequence_dups": f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_REST}) AS rn FROM lineitem)
SELECT a.l_orderkey, a.l_linenumber, a.l_partkey AS first_part, a.l_suppkey AS first_supp, b.l_partkey AS second_part, b.l_suppkey AS second_supp
FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber AND a.rn = 1 AND b.rn = 2""",
    "sequence_gaps": _gaps("number", ", part"),
    "sequence_gaps_chunked": _gaps("l_linenumber", ""),
    "state_sequence": f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {_REST}) AS p FROM lineitem),
s AS (SELECT *, max(CASE WHEN l_linestatus = 'O' THEN p END) OVER (PARTITION BY l_orderkey) AS lp,
        max(CASE WHEN l_linestatus = 'O' THEN l_linenumber END) OVER (PARTITION BY l_orderkey) AS last_number FROM r)
SELECT l_orderkey, l_linenumber, {_REST}, l_returnflag, last_number FROM s
WHERE l_linestatus <> 'O' AND CASE WHEN lp IS NULL THEN p = 1 ELSE p < lp END""",
    "carry_forward": f"""WITH {_EV}
SELECT user_id, event_id,
  last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_error,
  last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS view_before
FROM r""",
    "collapse_repeats": f"""WITH {_EV}, l AS (SELECT *, lag(event_type) OVER ({_W}) AS p FROM r)
SELECT user_id, event_id, event_type FROM l WHERE p IS NULL OR p <> event_type""",
    "running_total": f"""WITH {_EV}
SELECT user_id, event_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS purchases FROM r""",
    "first_open_block": f"""WITH {_EV}, p AS (SELECT *, row_number() OVER ({_W}) AS n FROM r),
s AS (SELECT user_id, min(n) AS s, arg_min(event_type, n) AS t FROM p WHERE value < 5 GROUP BY user_id),
e AS (SELECT p.user_id, min(n) AS e FROM p JOIN s ON p.user_id = s.user_id AND n >= s AND event_type <> t GROUP BY p.user_id)
SELECT p.user_id, event_id, event_type FROM p JOIN s ON p.user_id = s.user_id LEFT JOIN e ON p.user_id = e.user_id
WHERE n >= s AND (e IS NULL OR n < e) AND value < 5""",
    "version_asof": """WITH v AS (SELECT user_id, ts, min(event_id) AS version_id, arg_min(event_type, event_id) AS version_type,
  arg_min(value, event_id) AS version_value FROM events WHERE event_type <> 'purchase' GROUP BY user_id, ts)
SELECT o.user_id, o.event_id, v.version_id, v.version_type, v.version_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') o ASOF LEFT JOIN v ON o.user_id = v.user_id AND v.ts <= o.ts""",
    "version_responsible": f"""WITH o AS ({select('lineitem', OBJECTS)}),
a AS (SELECT version, arg_min({{'scheme': scheme_id, 'name': alternative_name}}, seq) AS alt
      FROM ({select('orders', ALTERNATIVES)}) WHERE dataset_name = 'gis' GROUP BY version),
s AS ({select('customer', SCHEMES)}), p AS ({select('nation', PROJECTS)}),
f AS (SELECT o.id, o.version, a.alt FROM o ASOF LEFT JOIN a ON a.version <= o.version)
SELECT f.id, f.version,
       CASE WHEN alt IS NULL THEN 'SIN ALTERNATIVA' WHEN s.scheme_id IS NULL THEN 'SIN SCHEME'
            WHEN p.project_id IS NULL THEN 'SIN PROYECTO' ELSE 'COMPLETO' END AS estado,
       CASE WHEN alt IS NULL THEN 'No se encontro alternativa para ds!version: ' || coalesce(CAST(f.version AS VARCHAR), 'unset')
            WHEN s.scheme_id IS NULL THEN 'Scheme no encontrado para id: ' || coalesce(CAST(alt.scheme AS VARCHAR), 'unset') END AS mensaje,
       alt.name AS alternative_name, s.name AS diseno, s.owner, s.modified_by AS modificado_por, s.modified_at AS fecha_modif,
       s.status, p.name AS proyecto, p.job_title AS proyecto_job, p.owning_group AS grupo_dueno,
       p.modified_by AS proyecto_mod_por, p.modified_at AS fecha_mod_proy
FROM f LEFT JOIN s ON s.scheme_id = alt.scheme LEFT JOIN p ON p.project_id = s.project_id""",
}
