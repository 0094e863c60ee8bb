"""Sheet lines built from customers: one sheet per supplier or nation, of any width."""

from __future__ import annotations

import re

from hilvan.catalog.base import table
from hilvan.sources import lines as L


def _lines(spark, d, text, *names):
    """The lines of ``text`` over the given tables."""
    marked = re.sub(r"\b(FROM|JOIN) (\w+) ", r"\1 {\2} ", text + " ")
    return spark.sql(marked, **{n: table(spark, d, n) for n in names})


# Cable sheets: the headers start at a column that differs by file, up to column 567.
_SHIFT = "CAST(s.s_suppkey % 8 * 80 AS INT)"
CABLE_LINES = f"""SELECT 'd/cab' || CAST(s.s_suppkey AS STRING) || '.csv' AS file_path, 'cab' || CAST(s.s_suppkey AS STRING) || '.csv' AS file,
1 AS line_no, repeat('x,', {_SHIFT}) || 'EC,PORT_EC,PATCHEO,PORT_OT,HILO,' ||
  CASE WHEN s.s_suppkey % 5 = 0 THEN '"ANILLO ORIGEN"' ELSE 'ANILLO ORIGEN' END || ',BUL'
  || CASE WHEN s.s_suppkey % 3 = 0 THEN ',EC' ELSE '' END AS line FROM supplier s WHERE s.s_suppkey % 13 <> 0
UNION ALL
SELECT 'd/cab' || CAST(s.s_suppkey AS STRING) || '.csv', 'cab' || CAST(s.s_suppkey AS STRING) || '.csv', CAST(c.c_custkey + 2 AS INT),
  repeat(',', {_SHIFT}) || CASE WHEN c.c_custkey % 4 = 0 THEN '' ELSE 'E' || CAST(c.c_custkey AS STRING) END || ', 1/0/'
  || CAST(c.c_custkey % 30 AS STRING) || ' ,"P' || CAST(c.c_nationkey AS STRING) || ',' || chr(34) || chr(34) || c.c_mktsegment || chr(34) || chr(34) || chr(34) || ',OT,'
  || CAST(c.c_custkey % 48 AS STRING) || ',ME-' || CAST(c.c_custkey % 6 AS STRING) || ',' || CAST(c.c_custkey % 3 AS STRING)
  || CASE WHEN s.s_suppkey % 3 = 0 THEN ',F' || CAST(c.c_custkey AS STRING) ELSE '' END
FROM customer c JOIN supplier s ON s.s_suppkey = c.c_custkey % 100 + 1"""


def cable_rows(spark, d):
    """Cable sheets of up to 567 columns."""
    found = L.cable_sheets(_lines(spark, d, CABLE_LINES, "supplier", "customer"))
    return found.select("fibra", "ec", "port_ec", "patcheo", "odf_calle", "hilo", "anillo_origen", "line_no")


# Equipment sheets: the wanted columns in another order per file, or without headers.
CENTRAL_LINES = """SELECT 'd/eq' || CAST(n.n_nationkey AS STRING) || '.csv' AS file_path, 'eq' || CAST(n.n_nationkey AS STRING) || '.csv' AS file,
1 AS line_no, CASE n.n_nationkey % 3 WHEN 0 THEN 'id,Puerto,ODF,Cassetera,Pos,x' WHEN 1 THEN 'Pos,Interfaz,Cassette,x,odf,y' ELSE 'a,b,c,d,e,f' END AS line
FROM nation n
UNION ALL
SELECT 'd/eq' || CAST(n.n_nationkey AS STRING) || '.csv', 'eq' || CAST(n.n_nationkey AS STRING) || '.csv', CAST(c.c_custkey + 2 AS INT),
  CASE n.n_nationkey % 3
    WHEN 0 THEN 'i' || CAST(c.c_custkey AS STRING) || ',1/' || CAST(c.c_custkey % 9 AS STRING) || ',ODF,"T,' || CAST(c.c_custkey % 7 AS STRING) || '",' || CAST(c.c_custkey % 12 AS STRING) || ',z'
    WHEN 1 THEN CAST(c.c_custkey % 12 AS STRING) || ',2/' || CAST(c.c_custkey % 9 AS STRING) || ', T' || CAST(c.c_custkey % 7 AS STRING) || ' ,,ODF,z'
    ELSE ',3/' || CAST(c.c_custkey % 9 AS STRING) || ',7,T' || CAST(c.c_custkey % 7 AS STRING) || ',' || CAST(c.c_custkey % 12 AS STRING) || ',z' END
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey"""


def central_rows(spark, d):
    """Equipment sheets whose columns are found by header or by place."""
    found = L.central_sheets(_lines(spark, d, CENTRAL_LINES, "nation", "customer"))
    return found.select("archivo", "line_no", "puerto", "odf_original", "cassetera", "pos")


QUERIES = {"cable_sheets": cable_rows, "central_sheets": central_rows}

_Q = "chr(34)"
_CELLS = """regexp_extract_all(line || ',', '("(?:[^"]|"")*"|[^,]*),', 1)"""


def _cell(place: str) -> str:
    """Trimmed cell without its quotes; doubled quotes are one."""
    raw = f"trim(cells[{place}])"
    inner = f"replace({raw}[2:-2], {_Q} || {_Q}, {_Q})"
    return f"nullif(if(starts_with({raw}, {_Q}), {inner}, {raw}), '')"


SQL = {
    "cable_sheets": f"""WITH l AS ({CABLE_LINES}), c AS (SELECT *, {_CELLS} AS cells FROM l),
p AS (SELECT file_path, max(CASE WHEN t = 'EC' THEN i END) AS ec, max(CASE WHEN t = 'PORT_EC' THEN i END) AS port, max(CASE WHEN t = 'PATCHEO' THEN i END) AS pat,
        max(CASE WHEN t = 'PORT_OT' THEN i END) AS ot, max(CASE WHEN t = 'HILO' THEN i END) AS hilo, max(CASE WHEN t = 'ANILLO ORIGEN' THEN i END) AS ring,
        max(CASE WHEN t = 'BUL' THEN i END) AS bul
      FROM (SELECT file_path, trim(unnest(cells), '"') AS t, generate_subscripts(cells, 1) AS i FROM c WHERE line_no = 1) GROUP BY file_path)
SELECT left(file, length(file) - 4) AS fibra, {_cell('ec')} AS ec, {_cell('port')} AS port_ec, {_cell('pat')} AS patcheo, {_cell('ot')} AS odf_calle,
       {_cell('hilo')} AS hilo, {_cell('ring')} AS anillo_origen, line_no
FROM c JOIN p ON c.file_path = p.file_path WHERE line_no >= 2 AND cells[bul] = '1'""",
    "central_sheets": f"""WITH l AS ({CENTRAL_LINES}), c AS (SELECT *, {_CELLS} AS cells, CAST(substr(file, 3, length(file) - 6) AS INT) % 3 AS kind FROM l WHERE line_no = 1 OR line_no >= 7)
SELECT file AS archivo, line_no, CASE kind WHEN 0 THEN {_cell('2')} WHEN 1 THEN {_cell('2')} ELSE {_cell('2')} END AS puerto,
       CASE kind WHEN 0 THEN {_cell('3')} WHEN 1 THEN {_cell('5')} ELSE {_cell('3')} END AS odf_original,
       CASE kind WHEN 0 THEN {_cell('4')} WHEN 1 THEN {_cell('3')} ELSE {_cell('4')} END AS cassetera,
       CASE kind WHEN 0 THEN {_cell('5')} WHEN 1 THEN {_cell('1')} ELSE {_cell('5')} END AS pos
FROM c WHERE line_no >= 7""",
}
