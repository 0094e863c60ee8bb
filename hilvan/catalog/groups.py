"""Majorities, repeats, similar names, first and last wins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hilvan.catalog.base import LINE_ORDER, select, shape, table
from hilvan.operators import groups as G

LINES = [*LINE_ORDER, "l_returnflag", "l_linestatus", "l_returnflag || l_linestatus AS kind"]
NAMES = [
    "p_partkey",
    "CASE p_partkey % 6 WHEN 0 THEN upper(p_name || ' ' || p_brand || ' SAS') "
    "WHEN 1 THEN p_name || ' ' || p_brand || ' s a s' WHEN 2 THEN upper(p_name) || '  ' || p_brand || ' S.A.S.' "
    "WHEN 3 THEN p_name || ' (' || p_brand || '), sas ' WHEN 4 THEN p_name || ' ' || p_brand || ' sede' "
    "ELSE upper(p_name || ' ' || p_brand || ' SAS') END AS name",
]


def majority_outliers(spark, d):
    rows = shape(spark, d, "lineitem", LINES)
    out = G.minority_rows(rows, ["l_suppkey"], "kind", LINE_ORDER)
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "kind", "majority", "votes", "total")


def pooled(spark, d):
    rows = shape(spark, d, "lineitem", LINES)
    out = G.pooled_majority(rows, ["l_suppkey"], ["l_returnflag", "l_linestatus"], LINE_ORDER)
    return out.select("l_suppkey", "majority", "votes", "total", "kinds", F.round("percent", 6).alias("percent"))


#: Small parts, so that the lists of the given tables have several.
PART_BYTES = 20


def duplicates(spark, d):
    parts = table(spark, d, "part").select("p_name", "p_partkey")
    key = F.col("p_partkey")
    return G.duplicate_keys(parts, "p_name", "p_partkey", [key])


def duplicates_in_parts(spark, d):
    parts = table(spark, d, "part").select("p_name", "p_partkey")
    key = F.col("p_partkey")
    return G.duplicate_keys(parts, "p_name", "p_partkey", [key], part_bytes=PART_BYTES)


def similar(spark, d):
    rows = shape(spark, d, "part", NAMES)
    return G.similar_names(rows, "name", "p_partkey", ["p_partkey"])


def last_status(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    last = G.last_wins(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderkey"])
    first = G.first_wins(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderkey"])
    return last.join(
        first.withColumnsRenamed({"o_orderstatus": "first_status", "o_orderkey": "first_key"}), "o_custkey"
    )


def positions(spark, d):
    """Position of every order of a customer, ranked per month and customer."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return G.position_within(
        rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], F.trunc("o_orderdate", "month"), "position"
    ).select("o_custkey", "o_orderkey", "position")


QUERIES = {
    "majority_outliers": majority_outliers,
    "pooled_majority": pooled,
    "duplicate_keys": duplicates,
    "duplicate_keys_parts": duplicates_in_parts,
    "similar_names": similar,
    "first_last_wins": last_status,
    "position_within": positions,
}

_ORDER = ", ".join(LINE_ORDER)
_NAMED = f"""r AS (SELECT p_partkey, trim(name, chr(9) || chr(10) || ' ') AS name FROM ({select('part', NAMES)})),
n AS (SELECT name, count(*) AS c, min(p_partkey) AS f,
        replace(trim(regexp_replace(regexp_replace(lower(name), '[.,;()]', '', 'g'), '\\s+', ' ', 'g')), ' s a s', ' sas') AS k,
        CAST(NOT contains(name, '.') AS INT)
        + CAST(NOT contains(name, '  ') AND length(name) - length(replace(name, ' ', '')) < 3 AS INT) + 1
        + CAST(name = upper(name) AND NOT starts_with(upper(name), 'C.C') AND NOT starts_with(upper(name), 'NODO') AS INT) AS score
      FROM r GROUP BY name),
o AS (SELECT * FROM n WHERE NOT (contains(lower(name), 'subred') OR contains(lower(name), 'sede') OR starts_with(lower(name), 'ant cm'))),
b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c DESC, score DESC, f) AS rn, count(*) OVER (PARTITION BY k) AS g FROM o),
w AS (SELECT k, name AS best FROM b WHERE rn = 1 AND g > 1)"""

SQL = {
    "majority_outliers": f"""WITH r AS ({select('lineitem', LINES)}),
s AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}, kind) AS pos FROM r),
c AS (SELECT l_suppkey, kind, count(*) AS n, min(pos) AS f FROM s GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, f) AS rn,
        CAST(sum(n) OVER (PARTITION BY l_suppkey) AS BIGINT) AS total FROM c)
SELECT r.l_suppkey, l_orderkey, l_linenumber, l_partkey, r.kind, m.kind AS majority, m.n AS votes, m.total
FROM r JOIN m ON r.l_suppkey = m.l_suppkey AND m.rn = 1 WHERE r.kind <> m.kind""",
    "pooled_majority": f"""WITH r AS ({select('lineitem', LINES)}),
s AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}, l_returnflag, l_linestatus) AS pos FROM r),
v AS (SELECT l_suppkey, pos * 2 AS pos, l_returnflag AS v FROM s
      UNION ALL SELECT l_suppkey, pos * 2 + 1, l_linestatus FROM s),
c AS (SELECT l_suppkey, v, count(*) AS n, min(pos) AS f FROM v WHERE v <> '' GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, f) AS rn,
        CAST(sum(n) OVER (PARTITION BY l_suppkey) AS BIGINT) AS total, count(*) OVER (PARTITION BY l_suppkey) AS kinds FROM c)
SELECT l_suppkey, v AS majority, n AS votes, total, kinds, round(n / total * 100, 6) AS percent FROM m WHERE rn = 1""",
    "duplicate_keys": """SELECT p_name, CAST(0 AS BIGINT) AS part, string_agg(CAST(p_partkey AS VARCHAR), ' , ' ORDER BY p_partkey) AS ids,
count(*) AS total FROM part GROUP BY p_name HAVING count(*) > 1""",
    "duplicate_keys_parts": f"""WITH r AS (SELECT *, coalesce(sum(strlen(CAST(p_partkey AS VARCHAR)) + 3) OVER (PARTITION BY p_name ORDER BY p_partkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // {PART_BYTES} AS part, count(*) OVER (PARTITION BY p_name) AS total FROM part)
SELECT p_name, part, string_agg(CAST(p_partkey AS VARCHAR), ' , ' ORDER BY p_partkey) AS ids, total
FROM r WHERE total > 1 GROUP BY p_name, part, total""",
    "similar_names": f"""WITH {_NAMED}
SELECT b.name, w.best, CAST(0 AS BIGINT) AS part, (SELECT string_agg(CAST(p_partkey AS VARCHAR), ', ' ORDER BY p_partkey) FROM r WHERE r.name = b.name) AS ids
FROM b JOIN w ON b.k = w.k WHERE b.name <> w.best""",
    "first_last_wins": """SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus,
arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS first_status, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_key
FROM orders GROUP BY o_custkey""",
    "position_within": """SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS position
FROM orders""",
}
