"""Keyed edits of parts by lines built from orders, and point lookups."""

from __future__ import annotations

from hilvan.catalog.base import select, shape, table
from hilvan.operators import bulk as B

TARGET = [
    "p_partkey AS id", "p_name AS name", "p_brand AS physical_status", "p_type AS type",
    "CAST(p_size AS BIGINT) AS ancho_de_banda", "DATE '2020-01-01' AS fecha_aprovisionamiento",
]
# Lines with one field, three fields, an unknown id, an id that is no number, and good ones.
LINES = [
    "o_orderkey AS line_no",
    "CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_custkey AS STRING) "
    "WHEN o_orderkey % 11 = 1 THEN CAST(o_custkey AS STRING) || '|a|b' WHEN o_orderkey % 11 = 2 THEN 'x|' || o_orderstatus "
    "WHEN o_orderkey % 11 = 3 THEN CAST(o_custkey + 1000000000 AS STRING) || '|' || o_orderstatus "
    "WHEN o_orderkey % 11 = 4 THEN CAST(o_custkey AS STRING) || '|' "
    "ELSE CAST(o_custkey AS STRING) || '|' || o_orderpriority END AS line",
]
NUMBERS = [
    "o_orderkey AS line_no",
    "CAST(o_custkey AS STRING) || CASE WHEN o_orderkey % 9 = 0 THEN '|x' WHEN o_orderkey % 9 = 1 THEN '|' "
    "WHEN o_orderkey % 9 = 2 THEN '|12.5' WHEN o_orderkey % 9 = 3 THEN '' ELSE '|' || CAST(o_orderkey % 1000 AS STRING) END AS line",
]
DATES = [
    "o_orderkey AS line_no",
    "CAST(o_custkey AS STRING) || '|' || CASE WHEN o_orderkey % 5 = 0 THEN 'ayer' WHEN o_orderkey % 5 = 1 THEN '' "
    "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS line",
]
DELETES = [
    "o_orderkey AS line_no",
    "CASE WHEN o_orderkey % 6 = 0 THEN 'id' || CAST(o_custkey AS STRING) WHEN o_orderkey % 6 = 1 THEN CAST(o_custkey + 1000000000 AS STRING) "
    "ELSE ' ' || CAST(o_custkey AS STRING) END AS line",
]
FIELDS = (("name", "string"), ("ancho_de_banda", "number"), ("fecha_aprovisionamiento", "date"))
REPORT = ("name", "ancho_de_banda", "fecha_aprovisionamiento")
MERGES = [
    "o_orderkey AS line_no",
    "CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_custkey AS STRING) || '|n' ELSE "
    "CASE WHEN o_orderkey % 7 = 1 THEN CAST(o_custkey + 1000000000 AS STRING) ELSE CAST(o_custkey AS STRING) END || '|' || o_orderpriority || '|' || "
    "CASE WHEN o_orderkey % 7 = 2 THEN 'x' WHEN o_orderkey % 7 = 3 THEN '' ELSE CAST(o_orderkey % 100 AS STRING) END || '|' || "
    "CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN 'ayer' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END END AS line",
]
CHANGED = [
    "c_custkey + 500 AS c_custkey", "lower(c_name) AS c_name", "c_nationkey", "-c_acctbal AS c_acctbal", "c_mktsegment",
]
ASKED = [
    "o_orderkey AS line_no",
    "CASE WHEN o_orderkey % 3 = 0 THEN 'falta ' || CAST(o_orderkey AS STRING) WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey AS STRING) "
    "ELSE 'Customer#' || CAST(o_custkey AS STRING) END AS line",
]
FOUND = ["c_custkey AS id", "CASE WHEN c_custkey % 2 = 0 THEN 'Customer#' || CAST(c_custkey AS STRING) ELSE 'Customer#' || CAST(c_custkey % 50 AS STRING) END AS name"]

VERIFIED = B.Edit("port", "ancho_de_banda", "number", verify=True)
CAPPED = B.Edit("port", "physical_status", max_lines=1000)


def _update(lines, edit, which):
    return lambda s, d: B.bulk_update(shape(s, d, "part", TARGET), shape(s, d, "orders", lines), edit)[which]


def _delete(which):
    return lambda s, d: B.bulk_delete(shape(s, d, "part", TARGET), shape(s, d, "orders", DELETES))[which]


def _merge(which):
    return lambda s, d: B.bulk_merge(
        shape(s, d, "part", TARGET), shape(s, d, "orders", MERGES), FIELDS, REPORT
    )[which]


def upsert(spark, d):
    return B.upsert(table(spark, d, "customer"), shape(spark, d, "customer", CHANGED), ["c_custkey", "absent"])


def _find(name):
    def run(spark, d):
        return B.find(shape(spark, d, "customer", FOUND), shape(spark, d, "orders", ASKED), B.LOOKUPS[name])

    return run


QUERIES = {
    "bulk_update_ledger": _update(LINES, B.EDITS["port_status"], 1),
    "bulk_update_table": _update(LINES, B.EDITS["port_status"], 0),
    "bulk_update_verified": _update(NUMBERS, VERIFIED, 1),
    "bulk_update_numbers": _update(NUMBERS, B.EDITS["port_bandwidth"], 0),
    "bulk_update_dates": _update(DATES, B.EDITS["port_provision_date"], 1),
    "bulk_update_capped": _update(LINES, CAPPED, 1),
    "bulk_counters": lambda s, d: B.ledger_counters(QUERIES["bulk_merge_ledger"](s, d)),
    "bulk_delete_ledger": _delete(1),
    "bulk_delete_table": _delete(0),
    "bulk_merge_ledger": _merge(1),
    "bulk_merge_table": _merge(0),
    "upsert": upsert,
    "find_by_name": _find("cable_by_name"),
    "find_by_id": _find("building_by_id"),
    "find_name": _find("building_name"),
}

_T = f"t AS ({select('part', TARGET)})"


def _lines(columns):
    return f"l AS (SELECT *, string_split(line, '|') AS f FROM ({select('orders', columns)}))"


_STATUS = f"""{_T}, {_lines(LINES)},
s AS (SELECT l.*, TRY_CAST(f[1] AS BIGINT) AS id, CASE WHEN len(f) <> 2 THEN 'FALLIDO'
        WHEN TRY_CAST(f[1] AS BIGINT) NOT IN (SELECT id FROM t) OR TRY_CAST(f[1] AS BIGINT) IS NULL THEN 'FALLIDO' ELSE 'EXITOSO' END AS status FROM l)"""
_NUM = f"""{_T}, {_lines(NUMBERS)},
s AS (SELECT *, TRY_CAST(f[1] AS BIGINT) AS id, TRY_CAST(NULLIF(f[2], '') AS DECIMAL(38,6)) AS v, f[2] AS x, len(f) = 2 AS fine FROM l)"""
_MERGE = f"""{_T}, {_lines(MERGES)},
s AS (SELECT *, TRY_CAST(f[1] AS BIGINT) AS id, len(f) = 4 AS fine, TRY_CAST(f[1] AS BIGINT) IN (SELECT id FROM t) AS known,
        f[3] = '' OR TRY_CAST(f[3] AS DOUBLE) IS NOT NULL AS ok2, f[4] = '' OR TRY_CAST(f[4] AS DATE) IS NOT NULL AS ok3 FROM l),
k AS (SELECT *, CASE WHEN NOT fine THEN 'FALLIDO_CAMPOS_INSUFICIENTES (se esperaban 17, se recibieron ' || len(f) || ')'
        WHEN NOT known THEN 'ID_NO_ENCONTRADO' WHEN ok2 AND ok3 THEN 'GS_EXITOSOS'
        ELSE 'CAMPOS_PARCIALES|name:OK, ancho_de_banda:' || CASE WHEN ok2 THEN 'OK' ELSE 'ERROR' END
          || ', fecha_aprovisionamiento:' || CASE WHEN ok3 THEN 'OK' ELSE 'ERROR' END END AS status FROM s)"""
_DELETE = f"""{_T}, l AS (SELECT *, TRY_CAST(trim(line) AS BIGINT) AS id FROM ({select('orders', DELETES)})),
s AS (SELECT line_no, line, id, CASE WHEN id IN (SELECT id FROM t) AND row_number() OVER (PARTITION BY id ORDER BY line_no) = 1
        THEN 'EXITOSO' ELSE 'FALLIDO' END AS status FROM l)"""
_LOG = "line_no, line, status, line || '|' || status AS ledger_line"
_FIND = f"""t AS (SELECT name, min(id) AS id FROM ({select('customer', FOUND)}) GROUP BY name),
i AS ({select('customer', FOUND)}), l AS ({select('orders', ASKED)})"""

SQL = {
    "bulk_update_ledger": f"WITH {_STATUS} SELECT {_LOG} FROM s",
    "bulk_update_table": f"""WITH {_STATUS}, c AS (SELECT id, arg_max(f[2], line_no) AS v FROM s WHERE status = 'EXITOSO' GROUP BY id)
SELECT t.* REPLACE (CASE WHEN c.id IS NULL THEN physical_status ELSE c.v END AS physical_status) FROM t LEFT JOIN c ON t.id = c.id""",
    "bulk_update_verified": f"""WITH {_NUM}, k AS (SELECT *, CASE WHEN NOT fine THEN 'FALLIDO|FORMATO_INCORRECTO'
  WHEN id NOT IN (SELECT id FROM t) THEN 'FALLIDO|NO_ENCONTRADO' WHEN v IS NULL AND x <> '' THEN 'FALLIDO|ERROR_EN_EJECUCION'
  WHEN v <> floor(v) THEN 'FALLIDO|NO_CAMBIO' ELSE 'EXITOSO' END AS status FROM s) SELECT {_LOG} FROM k""",
    "bulk_update_numbers": f"""WITH {_NUM}, c AS (SELECT id, max(line_no) AS m FROM s WHERE fine AND (v IS NOT NULL OR x = '') GROUP BY id)
SELECT t.* REPLACE (CASE WHEN c.id IS NULL THEN ancho_de_banda ELSE (SELECT CAST(floor(v) AS BIGINT) FROM s WHERE s.line_no = c.m) END AS ancho_de_banda)
FROM t LEFT JOIN c ON t.id = c.id""",
    "bulk_update_dates": f"""WITH {_T}, {_lines(DATES)}, k AS (SELECT *, CASE WHEN TRY_CAST(f[2] AS DATE) IS NULL THEN 'FALLIDO - fecha no parseable'
  WHEN TRY_CAST(f[1] AS BIGINT) NOT IN (SELECT id FROM t) THEN 'FALLIDO' ELSE 'EXITOSO' END AS status FROM l) SELECT {_LOG} FROM k""",
    "bulk_update_capped": f"""WITH {_STATUS}, k AS (SELECT line_no, line, CASE WHEN line_no > 1000 THEN 'SIN_PROCESAR' ELSE status END AS status FROM s)
SELECT {_LOG} FROM k""",
    "bulk_counters": f"WITH {_MERGE} SELECT regexp_extract(status, '^([A-Z_]+)', 1) AS status, count(*) AS lines FROM k GROUP BY 1",
    "bulk_delete_ledger": f"WITH {_DELETE} SELECT {_LOG} FROM s",
    "bulk_delete_table": f"WITH {_DELETE} SELECT * FROM t WHERE id NOT IN (SELECT id FROM l WHERE id IS NOT NULL)",
    "bulk_merge_ledger": f"WITH {_MERGE} SELECT {_LOG} FROM k",
    "bulk_merge_table": f"""WITH {_MERGE}, a AS (SELECT * FROM k WHERE fine AND known),
c AS (SELECT id, max(line_no) AS m1, max(line_no) FILTER (WHERE ok2) AS m2, max(line_no) FILTER (WHERE ok3) AS m3 FROM a GROUP BY id)
SELECT t.* REPLACE (
  CASE WHEN m1 IS NULL THEN name ELSE (SELECT f[2] FROM s WHERE line_no = m1) END AS name,
  CASE WHEN m2 IS NULL THEN ancho_de_banda ELSE (SELECT CAST(TRY_CAST(f[3] AS DOUBLE) AS BIGINT) FROM s WHERE line_no = m2) END AS ancho_de_banda,
  CASE WHEN m3 IS NULL THEN fecha_aprovisionamiento ELSE (SELECT TRY_CAST(f[4] AS DATE) FROM s WHERE line_no = m3) END AS fecha_aprovisionamiento)
FROM t LEFT JOIN c ON t.id = c.id""",
    "upsert": f"""WITH n AS ({select('customer', CHANGED)}) SELECT * FROM n
UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM n)""",
    "find_by_name": f"""WITH {_FIND} SELECT line_no, line, CASE WHEN t.id IS NULL THEN 'N/A ' || line ELSE t.id || '|' || line END AS output
FROM l LEFT JOIN t ON l.line = t.name""",
    "find_by_id": f"""WITH {_FIND} SELECT line_no, line, CASE WHEN i.id IS NULL THEN line || '&!' ELSE '"' || line || '"|' || i.name END AS output
FROM l LEFT JOIN i ON TRY_CAST(l.line AS BIGINT) = i.id""",
    "find_name": f"""WITH {_FIND} SELECT line_no, line, CASE WHEN i.id IS NULL THEN line || '&N/A' ELSE line || ',' || i.name END AS output
FROM l LEFT JOIN i ON TRY_CAST(l.line AS BIGINT) = i.id""",
}
